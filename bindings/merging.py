"""Merges over lineitem: an early part is the store, a later part the batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.operators import merge
from assayframe.schemas import PARSE_STATUSES
from bindings.core import Role, bound, ctes, load

CELLS = Role(
    "lineitem",
    {
        "sample_uid": "'S' || l_suppkey",
        "feature_uid": "'P' || l_partkey",
        "value": "CASE WHEN l_quantity < 6 THEN NULL ELSE l_extendedprice END",
        "unit": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END",
        "file_id": "CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE 'F' || l_orderkey % 300 END",
        "col_index": "l_linenumber",
        "line_no": "l_orderkey",
        "price": "l_extendedprice",
        "shipped": "l_shipdate",
        "part": "l_linenumber",
    },
)
STORED, GIVEN = "part <= 3", "part >= 3"
ORDER = ["line_no", "col_index", "price", "shipped", "unit"]


def _cells(spark, sf_dir):
    cells = CELLS.load(spark, sf_dir)
    return cells.where(STORED), cells.where(GIVEN)


@bound(
    "merge_get_or_create",
    f"""WITH c AS ({CELLS.sql()})
    SELECT feature_uid, 'part ' || feature_uid AS name_raw,
      count(*) FILTER (WHERE {STORED}) > 0 AS stored
    FROM c GROUP BY 1""",
)
def merge_get_or_create(spark, sf_dir):
    """Every feature once: those of the store, and the rows the batch adds."""
    stored, given = (
        c.select("feature_uid", F.concat(F.lit("part "), "feature_uid").alias("name_raw"), "line_no")
        for c in _cells(spark, sf_dir)
    )
    store = merge.keep_first(stored, ["feature_uid"], [F.col("line_no")])
    added = merge.new_rows(store, given, ["feature_uid"], [F.col("line_no")])
    old = store.withColumn("stored", F.lit(True))
    return old.unionByName(added.withColumn("stored", F.lit(False))).drop("line_no")


SPLIT = f"""c AS ({CELLS.sql()}),
stored AS (SELECT * FROM c WHERE {STORED}), given AS (SELECT * FROM c WHERE {GIVEN}),
seen AS (SELECT *, row_number() OVER (PARTITION BY sample_uid, feature_uid
   ORDER BY line_no, col_index, price, shipped, unit) AS rn FROM stored),
old AS (SELECT * FROM seen WHERE rn = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_uid, feature_uid
   ORDER BY line_no, col_index, price, shipped, unit) AS rn FROM given)"""


def _store(stored):
    order = [F.asc_nulls_last(c) for c in ORDER]
    return merge.keep_first(stored, ["sample_uid", "feature_uid"], order)


@bound(
    "merge_coalesce_upsert",
    f"""WITH {SPLIT},
    new AS (SELECT sample_uid, feature_uid, arg_max(value, rn) FILTER (WHERE value IS NOT NULL) AS value,
       arg_max(unit, rn) FILTER (WHERE unit IS NOT NULL) AS unit FROM ranked GROUP BY 1, 2)
    SELECT coalesce(n.sample_uid, o.sample_uid) AS sample_uid,
      coalesce(n.feature_uid, o.feature_uid) AS feature_uid,
      coalesce(n.value, o.value) AS value, coalesce(n.unit, o.unit) AS unit,
      CASE WHEN o.sample_uid IS NULL THEN 'insert' WHEN n.sample_uid IS NULL THEN 'keep'
        WHEN coalesce(n.value, o.value) IS DISTINCT FROM o.value
          OR coalesce(n.unit, o.unit) IS DISTINCT FROM o.unit THEN 'update' ELSE 'skip' END AS _action
    FROM new n FULL JOIN old o ON n.sample_uid = o.sample_uid AND n.feature_uid = o.feature_uid""",
)
def merge_coalesce_upsert(spark, sf_dir):
    stored, given = _cells(spark, sf_dir)
    return merge.coalesce_upsert(_store(stored), given, ORDER)


FIRST_WINS = f"""WITH {SPLIT},
unseen AS (SELECT * FROM given g WHERE NOT EXISTS (SELECT 1 FROM old o
   WHERE o.file_id = g.file_id AND o.col_index = g.col_index AND o.feature_uid = g.feature_uid)),
first AS (SELECT *, row_number() OVER (PARTITION BY sample_uid, feature_uid
   ORDER BY line_no, col_index, price, shipped, unit NULLS LAST) AS rn FROM unseen),
added AS (SELECT * FROM first f WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old o
   WHERE o.sample_uid = f.sample_uid AND o.feature_uid = f.feature_uid))
"""


def _insert_first(spark, sf_dir):
    stored, given = _cells(spark, sf_dir)
    order = [F.asc_nulls_last(c) for c in ORDER]
    return _store(stored), given, merge.insert_first(_store(stored), given, order)


@bound(
    "merge_insert_first",
    FIRST_WINS + "SELECT sample_uid, feature_uid, value, unit, file_id, col_index FROM added",
)
def merge_insert_first(spark, sf_dir):
    _, _, added = _insert_first(spark, sf_dir)
    return added.select("sample_uid", "feature_uid", "value", "unit", "file_id", "col_index")


@bound(
    "merge_insert_stats",
    FIRST_WINS
    + """SELECT (SELECT count(*) FROM given) AS processed, (SELECT count(*) FROM added) AS inserted,
      (SELECT count(*) FROM given) - (SELECT count(*) FROM added) AS skipped""",
)
def merge_insert_stats(spark, sf_dir):
    _, given, added = _insert_first(spark, sf_dir)
    n, one = F.count("*"), F.lit(1)
    counts = given.agg(n.alias("n")).select("n", F.lit(0).alias("k"))
    counts = counts.unionByName(added.agg(n.alias("n")).select("n", one.alias("k")))
    return counts.agg(
        F.sum(F.when(F.col("k") == 0, F.col("n"))).alias("processed"),
        F.sum(F.when(F.col("k") == 1, F.col("n"))).alias("inserted"),
    ).select("processed", "inserted", (F.col("processed") - F.col("inserted")).alias("skipped"))


# samples: the store has the pending half of the orders with gaps in their factors
BATCHES = """
old AS (SELECT sample_uid, sample_label, CASE WHEN factors_raw LIKE 'Group:c%' THEN '' ELSE factors_raw END
          AS factors_raw FROM samples WHERE sample_label NOT LIKE '%7'),
new AS (SELECT sample_uid, 'new ' || sample_label AS sample_label,
        CASE WHEN sample_label LIKE '%3' THEN NULL WHEN sample_label LIKE '%4' THEN ''
             ELSE 'Group:new' END AS factors_raw FROM samples WHERE sample_label NOT LIKE '%8')"""


def _sample_batches(spark, sf_dir):
    samples = load(spark, sf_dir, "samples")["samples"]
    label, factors = F.col("sample_label"), F.col("factors_raw")
    gaps = F.when(factors.startswith("Group:c"), "").otherwise(factors)
    old = samples.where(~label.endswith("7")).select("sample_uid", label, gaps.alias("factors_raw"))
    given = F.when(label.endswith("4"), "").otherwise("Group:new")
    new = samples.where(~label.endswith("8")).select(
        "sample_uid",
        F.concat(F.lit("new "), label).alias("sample_label"),
        F.when(~label.endswith("3"), given).alias("factors_raw"),
    )
    return old, new


def _action(state: str) -> str:
    return f"""CASE WHEN o.sample_uid IS NULL THEN 'insert' WHEN n.sample_uid IS NULL THEN 'keep'
      WHEN {state} THEN 'update' ELSE 'skip' END AS _action"""


@bound(
    "merge_fill_missing",
    ctes("samples").rstrip()
    + f""",{BATCHES},
    j AS (SELECT coalesce(o.sample_uid, n.sample_uid) AS sample_uid,
        CASE WHEN o.sample_uid IS NULL THEN n.sample_label ELSE o.sample_label END AS sample_label,
        o.factors_raw AS was, CASE WHEN o.sample_uid IS NULL THEN n.factors_raw
          WHEN n.sample_uid IS NULL OR o.factors_raw <> '' THEN o.factors_raw
          WHEN n.factors_raw <> '' THEN n.factors_raw ELSE o.factors_raw END AS factors_raw,
        o.sample_uid AS ou, n.sample_uid AS nu
      FROM old o FULL JOIN new n ON o.sample_uid = n.sample_uid)
    SELECT sample_uid, sample_label, factors_raw, CASE WHEN ou IS NULL THEN 'insert'
      WHEN nu IS NULL THEN 'keep' WHEN was IS DISTINCT FROM factors_raw THEN 'update'
      ELSE 'skip' END AS _action FROM j""",
)
def merge_fill_missing(spark, sf_dir):
    old, new = _sample_batches(spark, sf_dir)
    rules = {"sample_label": "keep", "factors_raw": "fill_empty"}
    return merge.merge(old, new, ["sample_uid"], rules)


@bound(
    "merge_replace_changed",
    ctes("samples").rstrip()
    + f""",{BATCHES}
    SELECT coalesce(o.sample_uid, n.sample_uid) AS sample_uid,
      coalesce(n.sample_label, o.sample_label) AS sample_label,
      CASE WHEN n.factors_raw <> '' THEN n.factors_raw
           WHEN o.sample_uid IS NULL THEN n.factors_raw ELSE o.factors_raw END AS factors_raw,
      CASE WHEN o.sample_uid IS NULL THEN 'insert' WHEN n.sample_uid IS NULL THEN 'keep'
        ELSE 'update' END AS _action
    FROM old o FULL JOIN new n ON o.sample_uid = n.sample_uid""",
)
def merge_replace_changed(spark, sf_dir):
    old, new = _sample_batches(spark, sf_dir)
    rules = {"sample_label": "latest", "factors_raw": "replace_filled"}
    return merge.merge(old, new, ["sample_uid"], rules)


ANALYSIS_BATCH = """
old AS (SELECT study_pk, analysis_id, file_id FROM analyses WHERE device IS NULL),
new AS (SELECT study_pk, analysis_id, 'N' || analysis_id AS file_id FROM analyses)"""


@bound(
    "merge_analyses",
    ctes("analyses").rstrip()
    + f""",{ANALYSIS_BATCH}
    SELECT n.study_pk, n.analysis_id, coalesce(o.file_id, n.file_id) AS file_id,
      CASE WHEN o.analysis_id IS NULL THEN 'insert' WHEN o.file_id IS NULL THEN 'update'
        ELSE 'skip' END AS _action
    FROM new n LEFT JOIN old o ON n.study_pk = o.study_pk AND n.analysis_id = o.analysis_id""",
)
def merge_analyses(spark, sf_dir):
    analyses = load(spark, sf_dir, "analyses")["analyses"]
    old = analyses.where(F.col("device").isNull())
    new = analyses.withColumn("file_id", F.concat(F.lit("N"), "analysis_id"))
    return merge.merge(old, new, ["study_pk", "analysis_id"], {"file_id": "fill_null"})


@bound(
    "merge_stats",
    ctes("samples").rstrip()
    + f""",{BATCHES}
    SELECT count(*) FILTER (WHERE n.sample_uid IS NOT NULL) AS processed,
      count(*) FILTER (WHERE o.sample_uid IS NULL) AS created,
      count(*) FILTER (WHERE o.sample_uid IS NOT NULL AND n.sample_uid IS NOT NULL) AS updated,
      0::BIGINT AS skipped
    FROM old o FULL JOIN new n ON o.sample_uid = n.sample_uid""",
)
def merge_stats(spark, sf_dir):
    return merge.merge_stats(merge_replace_changed(spark, sf_dir))


@bound(
    "dedup_keep_latest",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS user_id,
        CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type FROM events)
    SELECT event_id, user_id, event_type FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b
      WHERE a.event_id < b.event_id AND a.user_id = b.user_id AND a.event_type = b.event_type)""",
)
def dedup_keep_latest(spark, sf_dir):
    from bindings.core import table

    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS user_id",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type",
    )
    return merge.keep_latest(events, ["user_id", "event_type"], "event_id")


@bound(
    "status_rejects",
    ctes("files")
    + """SELECT file_id, CASE WHEN file_id LIKE '%5' THEN 'done' ELSE parse_status END AS parse_status
      FROM files WHERE file_id LIKE '%5' OR parse_status NOT IN
        ('pending', 'success', 'failed', 'skipped')""",
)
def status_rejects(spark, sf_dir):
    files = load(spark, sf_dir, "files")["files"].select("file_id", "parse_status")
    status = F.when(F.col("file_id").endswith("5"), "done").otherwise(F.col("parse_status"))
    _, rejected = merge.valid_rows(files.withColumn("parse_status", status), "parse_status", PARSE_STATUSES)
    return rejected
