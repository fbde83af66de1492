import random

import pytest
from pyspark.sql import functions as F

from assayframe.operators import merge, skew


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


MEAS = "sample_uid string, feature_uid string, value double, unit string, file_id string, col_index int, ord int"


def test_coalesce_upsert(spark):
    store = table(
        spark,
        [("s", "a", 1.0, None, None, None, 0), ("s", "b", 2.0, "u", None, None, 0)],
        MEAS,
    )
    batch = table(
        spark,
        [
            ("s", "a", None, "v", None, None, 1),
            ("s", "b", None, None, None, None, 2),
            ("s", "c", 5.0, None, None, None, 3),
            ("s", "c", 6.0, "x", None, None, 4),
            ("s", "c", None, "y", None, None, 5),
        ],
        MEAS,
    )
    out = merge.coalesce_upsert(store, batch, ["ord"])
    assert rows_of(out, "feature_uid", "value", "unit", "_action") == [
        ("a", 1.0, "v", "update"),
        ("b", 2.0, "u", "skip"),
        ("c", 6.0, "y", "insert"),
    ]
    again = merge.coalesce_upsert(out.drop("_action"), batch, ["ord"])
    assert again.where("_action <> 'skip'").count() == 0


def brute_insert_first(store, batch):
    """Row after row, as a sequential loader would."""
    cells = {(r[4], r[5], r[1]) for r in store if r[4] is not None}
    pairs = {(r[0], r[1]) for r in store}
    added = []
    for r in sorted(batch, key=lambda r: r[6]):
        if (r[4] is not None and (r[4], r[5], r[1]) in cells) or (r[0], r[1]) in pairs:
            continue
        pairs.add((r[0], r[1]))
        added.append(r)
    return added


@pytest.mark.parametrize("seed", range(4))
def test_insert_first_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(n, start):
        return [
            (
                f"s{rng.randrange(8) if rng.random() > 0.3 else 0}",
                f"f{rng.randrange(9)}",
                rng.choice([None, 1.5, 2.5]),
                "u",
                rng.choice([None, "A", "B"]),
                rng.randrange(5),
                start + i,
            )
            for i in range(n)
        ]

    store = brute_insert_first([], some(25, 0))
    batch = some(150, 1000)
    out = merge.insert_first(table(spark, store, MEAS), table(spark, batch, MEAS), [F.col("ord")])
    assert sorted(r.ord for r in out.collect()) == sorted(r[6] for r in brute_insert_first(store, batch))
    merged = table(spark, store + brute_insert_first(store, batch), MEAS)
    assert merge.insert_first(merged, table(spark, batch, MEAS), [F.col("ord")]).count() == 0


def test_first_row_wins_even_when_null(spark):
    batch = table(spark, [("s", "f", None, "u", "A", 1, 1), ("s", "f", 3.0, "u", "A", 2, 2)], MEAS)
    out = merge.insert_first(batch.limit(0), batch, [F.col("ord")])
    assert rows_of(out, "value", "col_index") == [(None, 1)]


@pytest.mark.parametrize(
    "rule, old, new, want, action",
    [
        ("keep", None, "n", None, "skip"),
        ("fill_null", None, "n", "n", "update"),
        ("fill_null", "", "n", "", "skip"),
        ("fill_empty", "", "n", "n", "update"),
        ("fill_empty", "", "", "", "skip"),
        ("fill_empty", "o", "n", "o", "skip"),
        ("replace_filled", "o", "", "o", "skip"),
        ("replace_filled", "o", "n", "n", "update"),
        ("latest", "o", None, "o", "skip"),
        ("latest", "o", "", "", "update"),
    ],
)
def test_rules(spark, rule, old, new, want, action):
    schema = "k string, v string"
    out = merge.merge(
        table(spark, [("k", old), ("only", "o")], schema),
        table(spark, [("k", new), ("fresh", "n")], schema),
        ["k"],
        {"v": rule},
    )
    assert rows_of(out, "k", "v", "_action") == sorted(
        [("k", want, action), ("only", "o", "keep"), ("fresh", "n", "insert")], key=str
    )
    stats = merge.merge_stats(out).first()
    assert (stats.processed, stats.created, stats.updated + stats.skipped) == (2, 1, 1)


def test_new_rows_and_keep_latest(spark):
    schema = "k string, n int"
    store = table(spark, [("a", 1)], schema)
    batch = table(spark, [("a", 2), ("b", 4), ("b", 3)], schema)
    assert rows_of(merge.new_rows(store, batch, ["k"], [F.col("n")]), "k", "n") == [("b", 3)]
    nulls = table(spark, [(None, 1), (None, 2), ("a", 1), ("a", 5)], schema)
    assert rows_of(merge.keep_latest(nulls, ["k"], "n"), "k", "n") == [
        ("a", 5),
        (None, 1),
        (None, 2),
    ]


def test_status_domain(spark):
    df = table(spark, [("pending",), ("odd",), (None,)], "s string")
    good, bad = merge.valid_rows(df, "s", ["pending", "success"])
    assert good.count() == 1 and bad.count() == 2


def hot_rows(n=3000):
    """A third of the rows has one key."""
    return [(i, 0 if i % 3 == 0 else i % 200) for i in range(n)]


@pytest.mark.parametrize("min_rows", [1, 100, 10_000])
def test_salted_lookup_is_a_plain_left_join(spark, min_rows):
    facts = table(spark, hot_rows(), "id int, k int").repartition(7)
    dim = table(spark, [(k, f"d{k}") for k in range(150)], "k int, d string")
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    got = skew.salted_lookup(
        facts, dim, ["k"], counts=counts, n="n", spread_by=["id"], min_rows=min_rows, salts=5
    )
    assert rows_of(got, "id", "k", "d") == rows_of(facts.join(dim, "k", "left"), "id", "k", "d")


def test_hot_key_is_spread(spark):
    facts = table(spark, hot_rows(), "id int, k int")
    dim = table(spark, [(k, f"d{k}") for k in range(200)], "k int, d string")
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = skew.salted_lookup(
            facts, dim, ["k"], counts=counts, n="n", spread_by=["id"], min_rows=500, salts=64
        )
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 0.3 * 3000


def test_hot_keys_are_bounded(spark):
    counts = table(spark, [(k, 1000 + k) for k in range(50)], "k int, n int")
    hot = skew.hot_keys(counts, ["k"], "n", max_keys=7, min_rows=1000)
    assert sorted(r.k for r in hot.collect()) == list(range(43, 50))


def test_running_index_is_row_number(spark):
    df = table(spark, hot_rows(), "id int, k int").repartition(6)
    got = skew.running_index(df, ["k"], ["id"], F.floor(F.col("id") / 100))
    seen, want = {}, []
    for i, k in hot_rows():
        seen[k] = seen.get(k, 0) + 1
        want.append((i, seen[k]))
    assert rows_of(got, "id", "replicate_ix") == sorted(want, key=str)


def test_keep_first_limits_before_the_shuffle(spark):
    df = table(spark, hot_rows(), "id int, k int")
    plan = skew.keep_first(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_results_do_not_depend_on_partitions(spark):
    df = table(spark, [(f"f{i}", f"/p/{i:05d}", "h" if i % 3 else f"h{i}", 1) for i in range(500)],
               "file_id string, path_abs string, sha256 string, size_bytes int")
    results = [
        rows_of(merge.mark_first_seen(df.repartition(n), min_rows=50, salts=4), "file_id", "canonical_id", "is_new")
        for n in (1, 8)
    ]
    assert results[0] == results[1]
    assert sum(r[2] for r in results[0]) == 1 + sum(1 for i in range(500) if i % 3 == 0)
