"""Incremental ingest: new files stream into a parsed table, or are merged into a store.

Parsing keeps no state, so the stream needs no watermark; which files were seen is in
its checkpoint, and what is stored decides about repeats when a batch is merged.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayframe.functions.filetypes import detected_type, filename_of
from assayframe.functions.text import drop_bad_utf8, once, without_mark
from assayframe.operators import mwtab
from assayframe.operators.mwtab import LAYOUTS
from assayframe.plans.load import load
from assayframe.plans.parse import Parsed, routed
from assayframe.sources.files import listing, path_of_uri, read_every, relative_path
from assayframe.sources.store import Store
from assayframe.sources.tables import settle

PATHS = "path string"


def stream_texts(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """(file_id, content) of files as they appear; ``max_files`` bounds one micro-batch."""
    raw = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    return raw.select(
        path_of_uri(F.col("_metadata.file_path")).alias("file_id"),
        without_mark(drop_bad_utf8(F.col("value"))).alias("content"),
    )


def _unseen(listed: DataFrame, root: str) -> Column:
    """Which listed files Spark's index leaves out: by a name below the root with "." or "_" in
    front, but for names with "=" and Parquet's own, which it takes."""
    below = relative_path(F.col("path"), re.sub("^file:/+", "/", root))
    return F.col("hidden") & F.coalesce(below, F.col("path")).rlike(
        r"(^|/)(\.|_(?!metadata|common_metadata)[^/=]*(/|$))"
    )


def take_hidden(spark: SparkSession, root: str, taken: str, max_files: int = 10_000) -> None:
    """Append the paths of hidden files that the table ``taken`` does not have yet.

    A file that is named but cannot be found is left for a later run.
    """
    listed = listing(spark, root)
    new = listed.where(_unseen(listed, root) & F.col("size_bytes").isNotNull()).select("path")
    try:
        new = settle(new.join(spark.read.schema(PATHS).parquet(taken), "path", "left_anti"), "hidden")
        if new.isEmpty():
            return
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    new.repartition(1).write.option("maxRecordsPerFile", max_files).mode("append").parquet(taken)


def stream_hidden_texts(spark: SparkSession, taken: str) -> DataFrame:
    """(file_id, content) of the files whose paths ``take_hidden`` wrote; a micro-batch takes one
    file of paths. A file that cannot be read is an error, as in ``stream_texts``."""
    paths = spark.readStream.schema(PATHS).option("maxFilesPerTrigger", 1).parquet(taken)
    tasks = spark.sparkContext.defaultParallelism
    read = paths.repartition(tasks, "path").mapInPandas(
        read_every, "path string, content binary"
    )
    return read.select(
        F.col("path").alias("file_id"),
        without_mark(drop_bad_utf8(F.col("content"))).alias("content"),
    )


def parsed_stream(texts: DataFrame) -> DataFrame:
    """Cells of every file, by the layout its section markers show."""
    read = once(texts, "content")
    typed = once(read.withColumn("layout", mwtab.layout_by_markers(F.col("content"))), "layout")
    parts = [
        mwtab.measurements(typed.where(F.col("layout") == name), layout).withColumn(
            "layout", F.lit(name)
        )
        for name, layout in LAYOUTS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def append_available(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a Parquet table, then stop. Safe to repeat: the
    checkpoint and the sink's log together write each file's rows once."""
    return (
        rows.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def merge_available(
    texts: DataFrame, store: Store, checkpoint: str, name: str, created_at=None
) -> StreamingQuery:
    """Merge the files that are there now into a store, a commit for each micro-batch, then stop.

    ``texts``: a stream of (file_id, content). The commits are named after the stream and its batch:
    a batch that Spark replays, because its job died between the commit and the checkpoint, is found
    in the store and left alone; one that died before the commit left nothing there.
    """

    def load_batch(rows: DataFrame, number: int) -> None:
        batch = f"{name} {number}"
        if store.has(batch):
            return
        # a stream goes by the markers alone, whatever the files are called
        layout = mwtab.layout_by_markers(F.col("content"))
        named = detected_type(filename_of(F.col("file_id")), F.col("content"))
        files = rows.withColumn("layout", layout)
        files = routed(files.withColumn("detected_type", F.coalesce("layout", named)))
        load(
            store,
            files.select("file_id", "detected_type"),
            Parsed(files.where("layout IS NOT NULL"), "layout"),
            batch,
            created_at=created_at,
        )

    return (
        texts.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(spark: SparkSession, root: str, table: str, checkpoint: str) -> DataFrame:
    """Parse the new files below ``root`` into ``table`` and return the table.

    Hidden files come by a list of their paths, kept with the checkpoint, and a second source of the
    same query; a checkpoint written with one source does not go on with two.
    """
    taken = f"{checkpoint.rstrip('/')}/hidden"
    take_hidden(spark, root, taken)
    texts = stream_texts(spark, root).unionByName(stream_hidden_texts(spark, taken))
    query = append_available(parsed_stream(texts), table, checkpoint)
    query.awaitTermination()
    return spark.read.parquet(table)
