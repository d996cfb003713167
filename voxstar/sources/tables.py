"""Lookup files, exported tables and the Parquet store of the star schema."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from voxstar.schemas import LEXICON_DDL, POPULATION_DDL, TABLES, WORLD_CITIES_DDL, table_schema
from voxstar.functions.location import STATE_CODES, map_values
from voxstar.session import CODEC
from voxstar.sources.files import listed, publish, remove, rename


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(term, emotion, association)."""
    return spark.read.schema(LEXICON_DDL).option("header", True).csv(path)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """(state code, pop)."""
    raw = spark.read.schema(POPULATION_DDL).option("header", True).csv(path)
    return raw.withColumn("state", map_values(F.col("state"), STATE_CODES))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """The world-cities sheet, as CSV."""
    return spark.read.schema(WORLD_CITIES_DDL).option("header", True).csv(path)


def read_export(spark: SparkSession, path: str, table: str) -> DataFrame:
    """An exported table: a JSON array of row objects with upper-case column names."""
    wanted = table_schema(table)
    exported = StructType([StructField(f.name.upper(), f.dataType) for f in wanted])
    return spark.read.schema(exported).option("multiLine", True).json(path).toDF(*wanted.names)


def keyword_terms(keywords: Column, limit: int | None = None) -> Column:
    """Ordered distinct keywords after the first, without nulls: all, or those among the next ``limit`` entries."""
    kept = F.slice(keywords, F.lit(2), F.size(keywords) if limit is None else F.lit(limit))
    return F.array_distinct(F.filter(kept, lambda k: k.isNotNull()))


def read_emoji_dict(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(emoji, terms) from a JSON object {emoji: [keyword, ...]}; ``limit`` as in ``keyword_terms``."""
    raw = spark.read.text(path, wholetext=True)
    entries = raw.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("emoji", "keywords"))
    return entries.select("emoji", keyword_terms(F.col("keywords"), limit).alias("terms"))


#: A row of the commit log. A capture or seed brings rows, a derivation covers the captures up to ``covers_to``, a rewrite puts new
#: partitions in place of old ones.
COMMIT_DDL = ("version bigint, kind string, load_key string, batch_id bigint, covers_to bigint, next_ids map<string,bigint>, "
              "replaces array<struct<table_name: string, origin: bigint, batch_id: bigint>>")
CAPTURE, DERIVATION, REWRITE, SEED = "capture", "derivation", "rewrite", "seed"
#: Loads that leave each other's results alone: what one of them committed meanwhile does not make the other stale.
_APART = ({CAPTURE, DERIVATION},)
#: Tables whose keys are looked up by every load, and their keys. They lie in so many folders by a hash of the first key column; a look-up
#: reads those its own keys fall into.
STORED_KEYS = {"users": ["author_id"], "tweet_text": ["tweet_id"], "tweet_data": ["tweet_id", "author_id", "search_id"]}
KEY_BUCKETS = 32


class StaleCommit(RuntimeError):
    """Another load committed after this one's snapshot, so its ids and key checks may be wrong; load again."""


class Store:
    """Star-schema tables as Parquet folders, one ``batch_id`` partition per load.

    A load writes its partitions under a number of its own and becomes visible with the file it adds to ``commits`` last. Commit
    files are numbered and never replaced: a load takes the number after its snapshot's, and if another one has it, the load is refused
    (``StaleCommit``), unless the other one cannot have touched what it read. A load that fails or is refused leaves partitions
    nobody reads, and its repetition starts under a new number, so a retry never doubles or mixes rows. Accepted and rejected
    rows are written in one pass, apart by the ``accepted`` partition.

    Which partitions are visible is a join with the commit log, so plans do not grow with the number of loads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version: int | None = None  # set in a snapshot, with what its log says as a whole

    def _scan(self, path: str, ddl: str, kind: str = "parquet") -> DataFrame:
        schema = StructType.fromDDL(ddl)
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.root}/{path.split('/')[0]}").format(kind).load(f"{self.root}/{path}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return literal_frame_of(self.spark, schema)

    def commits(self) -> DataFrame:
        """One row per finished load, up to the snapshot's version."""
        return self._scan("commits", COMMIT_DDL, "json") if self.version is None else self._log

    def snapshot(self) -> Store:
        """The store as of now; loads that finish later stay out of sight. The log is looked through once."""
        out, log = Store(self.spark, self.root), self._scan("commits", COMMIT_DDL, "json")
        found = log.agg(F.coalesce(F.max("version"), F.lit(0)).alias("version"), F.coalesce(F.max("covers_to"), F.lit(0)).alias("covers_to"),
                        F.count_if(F.col("kind") == REWRITE).alias("rewrites")).first()
        out.version, out._covers_to, out._rewrites = found["version"], found["covers_to"], found["rewrites"]
        out._log = log.filter(F.col("version") <= out.version)
        return out

    def next_id(self, column: str, seed: int) -> int:
        """The first free id, from the marks in the commit rows: the tables are not read."""
        top = self.commits().agg(F.max(F.col("next_ids")[column]).alias("top")).first()["top"]
        return max(seed, top or seed)

    def derived_to(self) -> int:
        """The version up to which captures have been derived from; 0 if none."""
        return self.snapshot()._covers_to if self.version is None else self._covers_to

    def has(self, load_key: str) -> bool:
        return not self.commits().filter(F.col("load_key") == load_key).isEmpty()

    def new_batch(self) -> int:
        return uuid.uuid4().int >> 65

    def visible(self, table: str) -> DataFrame:
        """(origin, kind, version, batch_id) of the table's visible partitions; ``origin`` is the load whose rows a rewrite moved."""
        done = self.commits()
        loads = done.select(F.col("batch_id").alias("origin"), "kind", "version")
        if self.version is not None and not self._rewrites:
            return loads.withColumn("batch_id", F.col("origin"))
        moved = (done.select("version", F.explode("replaces").alias("r")).filter(F.col("r.table_name") == table)
                 .groupBy(F.col("r.origin").alias("origin")).agg(F.max_by("r.batch_id", "version").alias("_moved")))
        return loads.join(moved, "origin", "left").select("origin", "kind", "version", F.coalesce("_moved", "origin").alias("batch_id"))

    def _rows(self, table: str, batches: DataFrame | int | None) -> DataFrame:
        fields = TABLES.get(table, "payload string")
        if "filepath" not in fields:
            fields += ", filepath string"
        fields += ", reject_reason string, batch_id long, accepted boolean"
        if isinstance(batches, int):  # the folder is named, so others are not listed
            return self._scan(f"{table}/batch_id={batches}", fields)
        return self._scan(table, fields).join((self.visible(table) if batches is None else batches).select("batch_id"), "batch_id", "left_semi")

    def read(self, table: str, batch: int | None = None) -> DataFrame:
        """Accepted rows of all finished loads, or of one load. Views are read with ``plans.catalog``."""
        return self._accepted(table, batch).select(*table_schema(table).names)

    def _accepted(self, table: str, batches: DataFrame | int | None) -> DataFrame:
        if table not in TABLES or table.startswith("vw_"):
            raise ValueError(f"{table} is no stored table; views are read with voxstar.plans.catalog")
        return self._rows(table, batches).filter("accepted")

    def read_captured(self, table: str, derived: bool) -> DataFrame:
        """Accepted rows of the captures derived from already, or of those still to be derived from."""
        after = F.col("version") > self.derived_to()
        captures = self.visible(table).filter((F.col("kind") == CAPTURE) & (~after if derived else after))
        return self._accepted(table, captures).select(*table_schema(table).names)

    def rejects(self, table: str, batch: int | None = None) -> DataFrame:
        """Rejected rows with their reason and source file."""
        return self._rows(table, batch).filter("NOT accepted").drop("accepted", "batch_id")

    def attempted(self, table: str, batch_id: int) -> DataFrame:
        """(filepath, reject_reason) of every row one load tried to write."""
        return self._rows(table, batch_id).select("filepath", "reject_reason")

    def _shaped(self, table: str, rows: DataFrame, *more: Column) -> DataFrame:
        fields = TABLES.get(table, "payload string")
        wanted = StructType.fromDDL(fields if "filepath" in fields else f"{fields}, filepath string")
        have = set(rows.columns)
        columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        reason = F.col("reject_reason") if "reject_reason" in have else F.lit(None).cast("string")
        return rows.select(*columns, reason.alias("reject_reason"), reason.isNull().alias("accepted"), *more)

    def write(self, table: str, rows: DataFrame, batch_id: int) -> tuple[int, int]:
        """Write the rows of one load; a non-null ``reject_reason`` marks a rejected row. Returns how many were loaded and skipped.

        The counts are taken by the tasks that write, so nothing is read for them.
        """
        seen = Observation()
        counted = self._shaped(table, rows).observe(seen, F.count_if("accepted").alias("loaded"), F.count_if(~F.col("accepted")).alias("skipped"))
        counted.write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}", partitionBy="accepted", compression=CODEC)
        return seen.get["loaded"], seen.get["skipped"]

    def keep(self, name: str, rows: DataFrame, batch_id: int, by: str) -> DataFrame:
        """Write an intermediate result of one load and read it back, so later steps start from it; ``drop`` removes it."""
        path = f"{self.root}/{name}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(path, partitionBy=by, compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(path)

    def kept_part(self, name: str, batch_id: int, part: str, ddl: str) -> DataFrame:
        """One partition of an intermediate result, by its folder, so that Spark judges its size alone."""
        return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}/batch_id={batch_id}/{part}")

    def drop(self, name: str, batch_id: int) -> None:
        remove(self.spark, f"{self.root}/{name}/batch_id={batch_id}")

    def discard(self, batch_id: int) -> None:
        """Remove everything a load wrote that was not committed."""
        for pattern in (f"*/batch_id={batch_id}", f"*/bucket=*/batch_id={batch_id}"):
            remove(self.spark, f"{self.root}/{pattern}")

    # --- keys by bucket

    def write_keys(self, table: str, batch_id: int) -> None:
        """Note the keys of the rows that a load accepted, a file per touched bucket."""
        self._note(table, self._accepted(table, batch_id))

    def _note(self, table: str, rows: DataFrame) -> None:
        keys = STORED_KEYS[table]
        noted = rows.select(*keys, "batch_id", key_bucket(keys[:1]).alias("bucket")).repartition("bucket")
        self._add(noted, f"{table}_keys", ["bucket", "batch_id"])

    def _add(self, rows: DataFrame, table: str, by: list[str], below: list[str] = ()) -> None:
        """Add partitions ``by`` to a folder that other loads may be writing to: Spark's writers clear a folder's temporary files when they
        end, so the rows are written apart and each partition is then renamed into place."""
        apart = f"{self.root}/_adding-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(apart, partitionBy=[*by, *below], compression=CODEC)
            for path in listed(self.spark, "/".join([apart, *(f"{c}=*" for c in by)])):
                rename(self.spark, path, "/".join([self.root, table, *path.split("/")[-len(by):]]))
        finally:
            remove(self.spark, apart)

    def known(self, table: str, wanted: DataFrame | None = None, touched: list[int] | None = None) -> DataFrame:
        """The visible stored keys of the buckets that ``wanted`` (with the first key column) falls into, or of those ``touched``; other
        buckets are not opened. At most KEY_BUCKETS numbers come to the driver.
        """
        keys, schema = STORED_KEYS[table], table_schema(table)
        if touched is None:
            touched = sorted(r[0] for r in wanted.select(key_bucket(keys[:1]).alias("bucket")).distinct().collect())
        ddl = ", ".join(f"{k} {schema[k].dataType.simpleString()}" for k in keys)
        rows = self._scan(f"{table}_keys/bucket={{{','.join(map(str, touched or [-1]))}}}", f"{ddl}, bucket int, batch_id long")
        return rows.join(self.visible(table).select("batch_id"), "batch_id", "left_semi").select(*keys)

    # --- changes of stored rows

    def read_placed(self, table: str) -> DataFrame:
        """Accepted rows with what is stored beside them: their source file and ``batch_id``, the partition they lie in."""
        return self._accepted(table, None).drop("accepted", "reject_reason")

    def rewrite(self, table: str, rows: DataFrame, touched: DataFrame) -> list[dict]:
        """Write new partitions in place of the touched ones (``touched`` has their ``batch_id``); returns their entries for the commit.

        ``rows`` are the accepted rows the touched partitions shall hold, as ``read_placed`` gives them. Rejected rows are taken over and
        keys noted anew. Other partitions and their files stay as they are, and so do the old ones for readers of older versions.
        """
        touched = touched.select("batch_id").distinct()
        moved = self.visible(table).join(touched, "batch_id", "left_semi").select("origin", "batch_id").collect()
        if not moved:
            return []
        numbers = [(r["batch_id"], self.new_batch()) for r in moved]
        fresh = self.spark.createDataFrame(numbers, "batch_id long, _new long")
        refused = self._rows(table, fresh).filter("NOT accepted").drop("accepted")
        placed = rows.unionByName(refused, allowMissingColumns=True).join(F.broadcast(fresh), "batch_id")
        shaped = self._shaped(table, placed, F.col("_new").alias("batch_id"))
        self._add(shaped, table, ["batch_id"], ["accepted"])
        if table in STORED_KEYS:
            written = self.spark.createDataFrame([(n,) for _, n in numbers], "batch_id long")
            self._note(table, self._accepted(table, written))
        return [{"table_name": table, "origin": r["origin"], "batch_id": n} for r, (_, n) in zip(moved, numbers)]

    def commit(self, batch_id: int, load_key: str, kind: str = CAPTURE, covers_to: int | None = None,
               next_ids: dict[str, int] | None = None, replaces: list[dict] | None = None) -> int:
        """Make a load visible, with the first ids it left free; returns its version, or raises StaleCommit.

        A store that is no snapshot commits after whatever is there.
        """
        base = self if self.version is not None else self.snapshot()
        version = base.version + 1
        while True:
            row = {"version": version, "kind": kind, "load_key": load_key, "batch_id": batch_id, "covers_to": covers_to,
                   "next_ids": next_ids or {}, "replaces": replaces or []}
            if publish(self.spark, f"{self.root}/commits/{version:020d}.json", json.dumps(row)):
                return version
            other = self._scan("commits", COMMIT_DDL, "json").filter(F.col("version") == version).first()["kind"]
            if self.version is not None and {kind, other} not in _APART:
                raise StaleCommit(f"{load_key}: version {version} is a {other} committed after the snapshot this {kind} worked on")
            version += 1


def key_bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")


def literal_frame_of(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame of a schema, planned without Python workers."""
    return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored star-schema table; a folder without a finished load is an error."""
    store = Store(spark, root)
    if store.commits().isEmpty():
        raise ValueError(f"{root} holds no finished load")
    return store.read(name)
