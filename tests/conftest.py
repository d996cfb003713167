import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from voxstar.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "voxstar-tests", shuffle_partitions=4, spark__driver__memory="4g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(ddl, rows) -> DataFrame"""
    return lambda ddl, rows: spark.createDataFrame(rows, ddl)


def rows_of(df, *columns):
    """Sorted row tuples of a small frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def rows():
    return rows_of
