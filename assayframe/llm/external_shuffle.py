"""Two-pass external shuffle into shards (operator 5). DataFrame functions only.

First pass: seeded hashes scatter the records uniformly into buckets of a size that a task holds in
memory. The shard comes first, by the greatest of one hash for each shard (rendezvous), so it
depends on the key and the number of shards alone, and one shard more takes records only into
itself. A shard is cut into as many buckets as its expected bytes ask for. Second pass: every bucket
is put in key order and then shuffled (Fisher-Yates, Spark's ``shuffle``) with a seed of its own. A
record's slot is its place in the bucket after the records of the shard's earlier buckets.

A bucket holds what ``payload`` asks for. The query shuffles and writes whole records and takes its
digest from what was written. The result does not depend on how tasks were cut, so a task that runs
again gives what it gave before.

Keys should be unique: rows with one key share a bucket, a null key is a key like any other. Null
texts have no bytes. Repeated rows get a slot each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayframe.llm import common
from assayframe.session import shared_folder

SHARDS = 24
SEED = 20_240_607
BUCKET_BYTES = 16 << 20
DRAWING_TASKS = 32  # tasks that draw orders, at least
TASK_BUCKETS = 32  # buckets of each shard that such a task draws for, at most
RECORD_BYTES = 8  # what a record takes besides its text


def text_bytes(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def _score(key: Column, shard: int, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(shard), key)


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the key is the greatest."""
    scores = F.array(*[_score(key, j, seed) for j in range(shards)])
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def grown_shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """shard_of with one shard more: that one, or the same as before."""
    before = F.greatest(*[_score(key, j, seed) for j in range(shards)])
    new = _score(key, shards, seed) > before
    return F.when(new, F.lit(shards)).otherwise(shard_of(key, shards, seed))


def shuffled(
    records: DataFrame,
    *,
    key: str,
    size: str,
    payload: Sequence[str],
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``payload`` of every record with its shard and its slot, gapless from 0 in each shard."""
    total = records.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    inside = F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), F.col(key)), F.lit(buckets))
    scattered = records.select(
        shard_of(F.col(key), shards, seed).alias("shard"),
        inside.cast("long").alias("bucket"),
        F.struct(F.col(key).alias("key"), _tie(records, payload).alias("tie")).alias("rank"),
        F.struct(*payload).alias("record"),
    )
    # records need no order of their own: only keys and hashes are sorted, with their places
    held = scattered.groupBy("shard", "bucket").agg(
        F.collect_list("record").alias("held"), F.collect_list("rank").alias("ranks")
    )
    places = F.sort_array(F.transform("ranks", lambda r, i: F.struct(r.alias("rank"), i.alias("at"))))
    held = held.select("shard", "bucket", "held", places.alias("places"))
    drawn = _orders(scattered.groupBy("shard", "bucket").agg(F.count("*").alias("n")), buckets, seed)
    dealt = F.transform("drawn", lambda place: F.get("held", F.get("places", place)["at"]))
    return (
        held.join(drawn, ["shard", "bucket"])
        .select("shard", "before", F.posexplode(dealt))
        .withColumn("slot", F.col("before") + F.col("pos"))
        .select(*[F.col("col")[c].alias(c) for c in payload], "shard", "slot")
    )


def _tie(records: DataFrame, payload: Sequence[str]) -> Column:
    """A hash of a record's content, for rows with one key; values without a hash go by their JSON."""
    whole = F.to_json(F.struct(*payload))
    plain = [c for c in payload if _hashable(records.schema[c].dataType)]
    return F.xxhash64(*plain) if len(plain) == len(payload) else F.xxhash64(whole)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, T.MapType | T.VariantType)


def _orders(sizes: DataFrame, buckets: int, seed: int) -> DataFrame:
    """For each bucket: the records ``before`` it in its shard, and its order, ``drawn``.

    ``shuffle`` draws on from one row of a partition to the next, and each partition starts with
    a seed of its own. So buckets have fixed partitions and a fixed order inside them.
    """
    number = F.col("shard").cast("long") * buckets + F.col("bucket")
    tasks = max(DRAWING_TASKS, buckets // TASK_BUCKETS)
    earlier = (
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("number", number)
        .repartitionById(tasks, (number % tasks).cast("int"))
        .sortWithinPartitions("number")
        .select(
            "shard",
            "bucket",
            "before",
            F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), F.lit(seed)).alias("drawn"),
        )
    )


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The whole records of documents as a folder for each shard, read back from there.

    Files are in slot order and hold whole buckets, so the records move once. Shard and slot are
    the last two columns; they take other names where documents have such columns.
    """
    shard, slot = common.free_name(docs, "shard"), common.free_name(docs, "slot")
    records = docs.select(
        "doc_id",
        (text_bytes(F.col("text")) + RECORD_BYTES).alias("size"),
        F.struct(*docs.columns).alias("record"),
    )
    out = shuffled(
        records, key="doc_id", size="size", payload=["record"], shards=shards, seed=seed
    )
    placed = out.select("record.*", F.col("slot").alias(slot), F.col("shard").alias(shard))
    placed.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
    back = docs.sparkSession.read.schema(placed.schema).parquet(path)
    return back.select(*docs.columns, shard, slot)


def digests(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of documents (doc_id, text).

    All of them are taken from the records that ``write_shards`` wrote.
    """
    path = shared_folder(docs.sparkSession, "shards")
    written = write_shards(docs, path, shards=shards, seed=seed)
    shard, slot = written.columns[-2:]
    text = F.coalesce("text", F.lit(""))
    return written.select(
        "doc_id",
        (text_bytes(F.col("text")) + RECORD_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col(shard).alias("shard"),
        F.col(slot).cast("long").alias("slot"),
        grown_shard_of(F.col("doc_id"), shards, seed).alias("grown_shard"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
