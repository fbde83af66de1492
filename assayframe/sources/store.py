"""A store of Parquet tables that batches change bucket by bucket.

Every row lies in the bucket of its key. A batch works out its buckets, reads those alone, and adds
segments: rows that are appended to a bucket, or rows that take the place of all it held. Segments
are written to folders of their own and are seen by nobody until the log names them; one file of
the log is one commit, which carries the batch's name. So a job that dies before its commit has
changed nothing, and one that runs again after it finds its name there.

Keys that belong together (samples of a study, features of an analysis) share ``groups`` buckets by
their first part, and spread over ``inside`` buckets within: a batch of few studies touches few
buckets, and a study with a third of all rows still lies in many. The registry of files is bucketed
by the prefix of its contents' hashes, so a batch of files meets the part of the registry that could
hold its contents.

One job at a time may write; readers may read any time. The driver holds one row for each
segment of the buckets it reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayframe import schemas
from assayframe.sources.tables import STORED_CODEC

GROUPS, INSIDE = 256, 16
LOG = "commit long, batch string, table string, bucket int, segment string, replaces boolean"
MOST_SEGMENTS = 8  # of a bucket, before it is worth rewriting as one
FILE_BUCKETS = T.StructType(
    [T.StructField("file_id", T.StringType()), T.StructField("held", T.IntegerType())]
)


def _hashed(key: str) -> Callable[[int, int], Column]:
    return lambda groups, inside: F.pmod(F.xxhash64(key), F.lit(groups * inside))


def _grouped(key: str) -> Callable[[int, int], Column]:
    """By the part of the key before the first colon, then by the key."""

    def bucket(groups: int, inside: int) -> Column:
        group = F.pmod(F.xxhash64(F.substring_index(key, ":", 1)), F.lit(groups))
        return group * inside + F.pmod(F.xxhash64(key, F.lit(1)), F.lit(inside))

    return bucket


def _by_prefix(digest: str) -> Callable[[int, int], Column]:
    """By the first hexadecimal digits of a digest."""
    return lambda groups, inside: F.pmod(
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(groups * inside)
    )


@dataclass(frozen=True)
class Kept:
    """A table of the store: its columns, and the bucket of a row."""

    shape: T.StructType
    bucket: Callable[[int, int], Column]


TABLES = {
    "imports": Kept(schemas.IMPORTS, _hashed("import_id")),
    "files": Kept(schemas.FILES, _by_prefix("sha256")),
    "studies": Kept(schemas.STUDIES, _hashed("study_id")),
    "analyses": Kept(schemas.ANALYSES, _hashed("study_pk")),
    "samples": Kept(schemas.SAMPLES, _grouped("sample_uid")),
    "sample_factors": Kept(schemas.SAMPLE_FACTORS, _grouped("sample_uid")),
    "features": Kept(schemas.FEATURES, _grouped("feature_uid")),
    "measurements": Kept(schemas.MEASUREMENTS, _grouped("sample_uid")),
    # in which buckets of the measurements a file has rows
    "file_buckets": Kept(FILE_BUCKETS, _hashed("file_id")),
}


@dataclass(frozen=True)
class Segment:
    table: str
    bucket: int
    folder: str
    replaces: bool


class Store:
    """The tables below a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        settings = spark.read.parquet(f"{self.root}/settings").first()
        self.groups, self.inside = settings["groups"], settings["inside"]

    @classmethod
    def create(cls, spark: SparkSession, root: str, groups: int = GROUPS, inside: int = INSIDE) -> Store:
        """An empty store. ``groups * inside`` buckets should hold about a gigabyte each."""
        root = root.rstrip("/")
        settings = spark.createDataFrame([(groups, inside)], "groups int, inside int")
        settings.coalesce(1).write.parquet(f"{root}/settings")
        first = spark.createDataFrame([(0, None, None, None, None, False)], LOG)
        first.coalesce(1).write.parquet(f"{root}/log")
        return cls(spark, root)

    # --- reading ---

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.root}/log")

    def has(self, batch: str) -> bool:
        return not self.log().where(F.col("batch") == batch).isEmpty()

    def bucket(self, table: str) -> Column:
        return TABLES[table].bucket(self.groups, self.inside).cast("int")

    def buckets_of(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets of a table that rows with its key belong to."""
        found = rows.select(self.bucket(table).alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in found if r["bucket"] is not None)

    def segments(self, table: str, buckets: Iterable[int] | None = None) -> list[Segment]:
        """What a table, or some buckets of it, consist of now."""
        log = self.log().where(F.col("table") == table)
        if buckets is not None:
            log = log.where(F.col("bucket").isin(list(buckets)))
        last = F.max(F.when(F.col("replaces"), F.col("commit"))).over(Window.partitionBy("bucket"))
        now = log.withColumn("last", last).where("commit >= coalesce(last, 0)")
        return [
            Segment(table, r["bucket"], r["segment"], r["replaces"])
            for r in now.orderBy("bucket", "commit").collect()
        ]

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or some buckets of it; the files of other buckets are not looked at."""
        paths = [f"{self.root}/{s.folder}/bucket={s.bucket}" for s in self.segments(table, buckets)]
        shape = _nullable(TABLES[table].shape)
        if not paths:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(*paths)

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in names or TABLES}

    # --- writing ---

    def write(self, table: str, rows: DataFrame, *, replaces: bool = False) -> tuple[list[Segment], int]:
        """Write rows as segments that nobody sees yet; and how many rows they are."""
        folder = f"{table}/{uuid.uuid4().hex}"
        placed = schemas.conform(rows, TABLES[table].shape).withColumn("bucket", self.bucket(table))
        # a bucket's rows come together, large buckets stay split over tasks
        together = placed.hint("rebalance", F.col("bucket"))
        together.write.option("compression", STORED_CODEC).partitionBy("bucket").parquet(
            f"{self.root}/{folder}"
        )
        # counted from the footers of what was written
        back = self.spark.read.schema(_nullable(placed.schema)).parquet(f"{self.root}/{folder}")
        counts = back.groupBy("bucket").agg(F.count("*").alias("n")).orderBy("bucket").collect()
        segments = [Segment(table, r["bucket"], folder, replaces) for r in counts]
        return segments, sum(r["n"] for r in counts)

    def commit(self, segments: Iterable[Segment], batch: str) -> int:
        """Make segments part of the store, all of them or none, under the batch's name."""
        number = self.log().agg(F.max("commit")).first()[0] + 1
        rows = [(number, batch, s.table, s.bucket, s.folder, s.replaces) for s in segments]
        entries = self.spark.createDataFrame(rows or [(number, batch, None, None, None, False)], LOG)
        entries.coalesce(1).write.mode("append").parquet(f"{self.root}/log")  # one file
        return number

    def change(self, table: str, state: DataFrame) -> tuple[list[Segment], int]:
        """Write what a merge changed, from merged rows with ``_action``; and how many were inserted.

        Buckets with updated rows are written anew, from ``state``, which must hold all their rows;
        others get the inserted rows only. Pass a stored state: it is read more than once.
        """
        place, action = self.bucket(table), F.col("_action")
        counts = (
            state.groupBy(place.alias("bucket"))
            .agg(F.count_if(action == "update").alias("updated"), F.count_if(action == "insert").alias("inserted"))
            .collect()
        )
        anew = sorted(r["bucket"] for r in counts if r["updated"])
        added = sorted(r["bucket"] for r in counts if r["inserted"] and not r["updated"])
        segments: list[Segment] = []
        if anew:
            segments += self.write(table, state.where(place.isin(anew)), replaces=True)[0]
        if added:
            new = state.where((action == "insert") & place.isin(added))
            segments += self.write(table, new)[0]
        return segments, sum(r["inserted"] for r in counts)

    def compact(self, table: str, most: int = MOST_SEGMENTS) -> int:
        """Write buckets of more than ``most`` segments as one each; the number of such buckets."""
        held: dict[int, int] = {}
        for s in self.segments(table):
            held[s.bucket] = held.get(s.bucket, 0) + 1
        crowded = [b for b, n in held.items() if n > most]
        if crowded:
            segments, _ = self.write(table, self.read(table, crowded), replaces=True)
            self.commit(segments, f"compact {uuid.uuid4().hex}")
        return len(crowded)


def _nullable(shape: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in shape])
