"""Operator 5: the law of the shards, gapless slots, and a uniform order that runs agree on."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from assayframe.llm import external_shuffle as es


def rows_of(df):
    return sorted((str(r["doc_id"]), *r[1:]) for r in df.collect())


def slots(rows):
    held = defaultdict(list)
    for r in rows:
        held[r["shard"]].append(r["slot"])
    return held


def test_query(spark, sf_dir, given):
    rows = es.query(spark, sf_dir).collect()
    assert len(rows) == len(given)
    for r in rows:
        data = (given[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], es.SHARDS)
    for held in slots(rows).values():
        assert sorted(held) == list(range(len(held)))


def test_shard_depends_on_id_and_count_alone(spark):
    from pyspark.sql import functions as F

    ids = spark.range(5_000).select(F.col("id").alias("doc_id"))
    found = ids.select(
        es.shard_of(F.col("doc_id"), 6).alias("six"),
        es.shard_of(F.col("doc_id"), 7).alias("seven"),
        es.grown_shard_of(F.col("doc_id"), 6).alias("grown"),
    ).collect()
    assert all(r["seven"] == r["grown"] for r in found)
    assert all(r["seven"] in (r["six"], 6) for r in found)
    counts = defaultdict(int)
    for r in found:
        counts[r["seven"]] += 1
    assert len(counts) == 7 and min(counts.values()) > 600


def test_order_is_the_same_however_tasks_are_cut(spark, monkeypatch):
    docs = spark.range(3_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 90 AS int)) AS text")
    monkeypatch.setattr(es, "BUCKET_BYTES", 4_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("2", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(rows_of(es.shuffled(
                docs.withColumn("size", es.text_bytes(docs.text) + 8),
                key="doc_id", size="size", payload=["doc_id"], shards=3, bucket_bytes=4_000,
            )))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]
    held = defaultdict(list)
    for doc_id, shard, slot in out[0]:
        held[shard].append((slot, int(doc_id)))
    for rows in held.values():
        order = [d for _, d in sorted(rows)]
        assert [s for s, _ in sorted(rows)] == list(range(len(rows)))
        # neighbours in the new order are as often rising as falling
        rising = sum(a < b for a, b in zip(order, order[1:], strict=False))
        assert 0.4 < rising / len(order) < 0.6


def test_edge_rows(edge_docs, no_docs):
    rows = es.digests(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r["size"] for r in rows if r["doc_id"] == 2} == {8}
    assert {r["text_crc32"] for r in rows if r["doc_id"] == 2} == {0}
    for held in slots(rows).values():
        assert sorted(held) == list(range(len(held)))
    assert es.digests(no_docs).count() == 0


def test_write_keeps_whole_records_in_order(spark, edge_docs, tmp_path):
    es.write_shards(edge_docs.withColumnRenamed("shard", "own"), str(tmp_path / "s"), shards=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == edge_docs.count()
    assert sorted(str(r["text"]) for r in back.collect()) == sorted(
        str(r["text"]) for r in edge_docs.collect()
    )


def test_query_digests_what_was_written(spark, sf_dir, given, tmp_path, monkeypatch):
    monkeypatch.setattr(es, "shared_folder", lambda spark, purpose: str(tmp_path / purpose), raising=False)
    rows = es.query(spark, sf_dir).collect()
    written = spark.read.parquet(str(tmp_path / "shards"))
    found = {r["doc_id"]: r for r in written.collect()}
    assert found.keys() == given.keys()
    for r in rows:
        record = found[r["doc_id"]]
        assert (record["shard"], record["slot"]) == (r["shard"], r["slot"])
        assert all(record[c] == given[r["doc_id"]][c] for c in given[r["doc_id"]].asDict())
    for file in (tmp_path / "shards").glob("*/*.parquet"):
        slots_of_file = [r["slot"] for r in spark.read.parquet(str(file)).collect()]
        assert slots_of_file == sorted(slots_of_file)


def test_columns_without_an_order(spark, tmp_path):
    """Maps and variants are carried; rows of one key have one order, however they come."""
    rows = [(i % 5, f"t{i}", {"a": i}, [{"b": i}]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, l array<map<string,int>>")
    df = df.withColumn("v", F.parse_json(F.lit("[1]")))
    out = [
        es.write_shards(d, str(tmp_path / n)).select("doc_id", "text", "m", "shard", "slot").collect()
        for n, d in (("a", df), ("b", df.repartition(7).orderBy(F.desc("text"))))
    ]
    found = [sorted((r["shard"], r["slot"], r["doc_id"], r["text"], r["m"]["a"]) for r in rows) for rows in out]
    assert found[0] == found[1] and len(found[0]) == 40
