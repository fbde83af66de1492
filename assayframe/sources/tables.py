"""Parquet tables: reading, appending, rewriting partitions, exporting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.session import shared_folder
from assayframe.sources.places import place

# Fixed values of the export sink.
EXPORT_CODEC = "zstd"
EXPORT_CODEC_LEVEL = 3
EXPORT_CHUNK_ROWS = 200_000
GROUP_ROWS = 20_000  # of a row group, where an export is to be filtered
STORED_CODEC = "zstd"  # of tables that jobs write and read again: about a third smaller than with snappy


@dataclass(frozen=True)
class ExportStats:
    output_path: str
    total_rows: int = 0
    total_chunks: int = 0
    file_size_bytes: int = 0


def widen(df: DataFrame, by: str) -> DataFrame:
    """Spread rows by a key if the scan is narrower than the cluster.

    For work that costs much per row. A table of many files has more scan tasks than
    there are cores and passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, by) if df.rdd.getNumPartitions() < cores else df


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and go on from the written table.

    For small results of expensive scans that are used more than once: the scan runs
    once, and a lost executor does not bring it back.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", STORED_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def touched_partitions(store: DataFrame, batch: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of the partitions a batch has rows for; Spark prunes the others from the scan."""
    return store.join(batch.select(*partition_by).distinct(), partition_by, "left_semi")


def rewrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for.

    ``df`` must not read from ``path`` lazily: write it elsewhere first, or pass rows
    of a checkpointed table.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by
    ).parquet(path)


def write_export(
    df: DataFrame,
    path: str,
    chunk_rows: int = EXPORT_CHUNK_ROWS,
    find_by: Sequence[str] = (),
    full_chunks: bool = False,
) -> ExportStats:
    """Write an export in chunks of at most ``chunk_rows`` rows; nothing is left for zero rows.

    Every task writes its own files, and the plan runs once. Readers that filter by the columns
    ``find_by`` skip what they need not read: each file is in their order, with small row groups,
    page statistics and Bloom filters. With ``full_chunks`` there are as few chunks as the rows need,
    all full but one, however many tasks write them.
    """
    spark = df.sparkSession
    if full_chunks:
        df = _dealt_in_chunks(df, chunk_rows)
    writer = (
        (df.sortWithinPartitions(*find_by) if find_by else df)
        .write.mode("overwrite")
        .option("compression", EXPORT_CODEC)
        .option("parquet.compression.codec.zstd.level", EXPORT_CODEC_LEVEL)
        .option("maxRecordsPerFile", chunk_rows)
    )
    for column in find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    if find_by:
        writer = writer.option("parquet.block.row.count.limit", GROUP_ROWS)
    writer.parquet(path)
    files = written_files(spark, path)
    sizes = files.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    rows = spark.read.schema(df.schema).parquet(path).count()  # from the footers
    if not rows:
        system, inside, _ = place(path)
        system.delete_dir(inside)
        return ExportStats(path)
    return ExportStats(path, rows, sizes["n"], sizes["bytes"])


def _dealt_in_chunks(df: DataFrame, chunk_rows: int) -> DataFrame:
    """``df``, dealt to tasks by whole chunks of ``chunk_rows`` rows.

    The rows are written once, so that file and place number them; the places of the files follow from
    their row counts, one row for each file, and no task sees all rows. A task that gets several chunks cuts
    them where a chunk is full, so only the one that has the last rows writes less.
    """
    rows = settle(df, "chunked").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    chunk = F.floor((F.col("_start") + F.col("_row")) / chunk_rows)
    placed = rows.join(F.broadcast(starts), "_file").withColumn("_chunk", chunk)
    return placed.repartition("_chunk").select(*df.columns)


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the part files of a table."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
