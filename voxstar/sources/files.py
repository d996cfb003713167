"""Single files and folders of a store, through the file system that their path names."""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby, islice

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxstar.shipping import ship

#: What Spark escapes in the folder names it writes.
_ESCAPED = re.compile(r"""[\x00-\x1F\x7F"#%'*/:=?\\{\[\]^]""")
#: Renames in flight where tasks cannot write files themselves.
_RENAMES = 32
#: Of paths that a URI holds as they are.
_PLAIN = re.compile(r"[A-Za-z0-9/_.!~*'(),;:$&+=@-]")
#: Rows of a listing, and bytes of content, that a task hands over at a time.
_ROWS, _BYTES = 10_000, 8 << 20
#: A file that tasks can open by ``path``; ``filepath`` is the name Spark's readers give it, ``modified`` is in milliseconds.
LISTING_DDL = "filepath string, path string, size long, modified long"


def _system(spark: SparkSession, path: str):
    """Hadoop's path and file system, and the local path if there is one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    local = system.makeQualified(target).toUri().getPath() if system.getUri().getScheme() == "file" else None
    return target, system, local


def remove(spark: SparkSession, pattern: str) -> None:
    """Delete what a path or glob pattern matches; nothing there is no error."""
    target, system, _ = _system(spark, pattern)
    for found in system.globStatus(target) or []:
        system.delete(found.getPath(), True)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob pattern."""
    target, system, _ = _system(spark, pattern)
    return sorted(found.getPath().toString() for found in system.globStatus(target) or [])


def matching(spark: SparkSession, pattern: str) -> int:
    """How many paths match a glob pattern.

    On local and network disks folders are walked entry by entry; elsewhere, and for patterns with more than ``*`` and ``?``, the file
    system lists all matches in the JVM.
    """
    target, system, local = _system(spark, pattern)
    if not local or re.search(r"[][{}\\]", pattern):
        return len(system.globStatus(target) or [])

    def count(folder: str, parts: list[str]) -> int:
        here, *below = parts
        if not re.search(r"[*?]", here):
            path = os.path.join(folder, here)
            return (count(path, below) if below else 1) if os.path.exists(path) else 0
        form = re.compile(re.escape(here).replace(r"\*", ".*").replace(r"\?", "."), re.DOTALL)
        try:
            with os.scandir(folder) as found:
                hits = (e for e in found if form.fullmatch(e.name))
                return sum(count(e.path, below) for e in hits if e.is_dir()) if below else sum(os.path.exists(e.path) for e in hits)
        except (FileNotFoundError, NotADirectoryError):
            return 0

    return count("/", [x for x in local.split("/") if x])


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Give a file another name, in a folder that is made if missing."""
    source, system, _ = _system(spark, old)
    target, _, _ = _system(spark, new)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


def _escape(name: str) -> str:
    return _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name)


def write_files(rows: DataFrame, root: str) -> None:
    """Write (folder, name, value) rows as text files ``root``/<folder>/<name>, a line per row; rows of one file lie in one task.

    On local and network disks the tasks write the files where they belong, each under a hidden name first, so a repeated task changes
    nothing and no step goes through the driver file by file. Elsewhere Spark writes a folder per file and the files are renamed from there.
    Rows without folder or name have no file.
    """
    spark = rows.sparkSession
    placed = rows.dropna(subset=["folder", "name"]).select("folder", "name", "value").repartition("folder", "name")
    _, _, local = _system(spark, root)
    if local:
        ship(spark)

        def write(part):
            made = set()
            for (folder, name), lines in groupby(part, key=lambda r: (r["folder"], r["name"])):
                where = os.path.join(local, _escape(folder))
                if where not in made:
                    os.makedirs(where, exist_ok=True)
                    made.add(where)
                draft = os.path.join(where, f"_draft-{uuid.uuid4().hex}")
                with open(draft, "x", encoding="utf-8", newline="") as out:
                    out.writelines(f"{line['value']}\n" for line in lines)
                os.replace(draft, os.path.join(where, _escape(name)))

        placed.sortWithinPartitions("folder", "name").foreachPartition(write)
        return
    apart = f"{root}/_written"
    placed.write.partitionBy("folder", "name").text(apart)

    def place(path):
        folder, name = (x.split("=", 1)[1] for x in path.split("/")[-3:-1])
        rename(spark, path, f"{root}/{folder}/{name}")

    with ThreadPoolExecutor(_RENAMES) as pool:
        list(pool.map(place, listed(spark, f"{apart}/folder=*/name=*/part-*")))
    remove(spark, apart)


def tasks_reach(spark: SparkSession, root: str) -> bool:
    """Whether tasks list and read the files below a folder themselves: on local and network disks; a glob pattern is no folder."""
    return not re.search(r"[][{}*?\\]", root) and _system(spark, root)[2] is not None


def _as_uri(path: str) -> str:
    """A path as Java's URI quotes it."""
    def kept(c: str) -> bool:
        return bool(_PLAIN.match(c)) if c < "\x80" else c > "\x9f" and unicodedata.category(c)[0] != "Z"

    return path if not _PLAIN.sub("", path) else "".join(c if kept(c) else "".join(f"%{b:02X}" for b in c.encode()) for c in path)


def _folder_files(folder: str, suffix: str) -> Iterator[tuple[str, int, int]]:
    """(path, size, modified) of the files directly in a folder that Spark's readers would see."""
    with os.scandir(folder) as found:
        for entry in found:
            name = entry.name
            if not name.endswith(suffix) or name[0] == "." or (name[0] == "_" and "=" not in name):
                continue
            try:
                if not entry.is_dir():
                    state = entry.stat()
                    yield entry.path, state.st_size, state.st_mtime_ns // 1_000_000
            except FileNotFoundError:  # gone meanwhile, or a link to nothing
                continue


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """The files with a suffix in the folders right below ``root``, and in ``root``, as rows of LISTING_DDL; a task lists a folder.

    Only the names of the folders come to the driver. ``tasks_reach`` tells where this works.
    """
    local = _system(spark, root)[2]
    try:
        with os.scandir(local) as found:
            folders = [local, *(e.path for e in found if e.is_dir())]
    except FileNotFoundError:
        folders = []
    ship(spark)

    def listed_in(batches):
        for batch in batches:
            rows = ((f"file:{_as_uri(p)}", p, n, t) for folder in batch.column(0).to_pylist() for p, n, t in _folder_files(folder, suffix))
            while part := list(islice(rows, _ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*part)], ["filepath", "path", "size", "modified"])

    named = spark.createDataFrame([(f,) for f in folders], "folder string")
    dealt = named.repartition(max(1, min(len(folders), 4 * spark.sparkContext.defaultParallelism)))
    return dealt.mapInArrow(listed_in, LISTING_DDL)


def read_files(files: DataFrame) -> DataFrame:
    """(filepath, value): the whole content of listed files, like Spark's text reader gives it; empty files and those gone give no row.

    Tasks open the files by path, so the driver holds none of them, and there are as many tasks as the bytes need, not as the files.
    """
    spark = files.sparkSession
    filled = files.filter("size > 0")
    found = filled.agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")).first()
    full = -(-(found["bytes"] or 0) // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    ship(spark)

    def content(batches):
        names, values, held = [], [], 0
        for batch in batches:
            for name, path in zip(*(batch.column(i).to_pylist() for i in range(2))):
                try:
                    with open(path, "rb") as source:
                        values.append(source.read())
                except FileNotFoundError:
                    if not os.path.isdir(os.path.dirname(path)):  # the disk is missing here, not the file
                        raise
                    continue
                names.append(name)
                held += len(values[-1])
                if held >= _BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values)], ["filepath", "value"])
                    names, values, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values)], ["filepath", "value"])

    dealt = filled.select("filepath", "path").repartition(max(1, min(found["files"], max(spark.sparkContext.defaultParallelism, full))))
    return dealt.mapInArrow(content, "filepath string, value binary").select("filepath", F.col("value").cast("string").alias("value"))


def publish(spark: SparkSession, path: str, text: str, linked: bool = True) -> bool:
    """Create a file with its whole content unless it exists; of several writers exactly one gets True.

    Readers see nothing or all of it: the content is written under a hidden name first. On local and network disks a hard link gives it its
    name (``linked``), elsewhere a rename that refuses an existing target.
    """
    target, system, local = _system(spark, path)
    draft = os.path.join(os.path.dirname(path), f"_draft-{uuid.uuid4().hex}")
    if local and linked:
        own = os.path.join(os.path.dirname(local), os.path.basename(draft))
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(own, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(own, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    hidden, _, _ = _system(spark, draft)
    out = system.create(hidden, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration()).rename(
            system.makeQualified(hidden), system.makeQualified(target), options)
        return True
    except Py4JJavaError as refused:
        system.delete(hidden, False)
        if "FileAlreadyExistsException" in refused.java_exception.getClass().getName():
            return False
        raise
