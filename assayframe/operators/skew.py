"""Joins and running counts that stay balanced when a few keys hold most rows.

Adaptive skew-join splits hot partitions of a sort-merge join only when both sides
come straight from a shuffle. It does not apply when one side is an aggregate on
the join key (its shuffle sits below the aggregate), nor to windows. The helpers
here cover those cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# At most HOT_KEYS keys are treated as hot, so the broadcast list of them has a fixed
# bound; every other key then holds less than 1/HOT_KEYS of all rows.
HOT_KEYS = 1000
HOT_ROWS = 1_000_000
SALTS = 256


def hot_keys(
    counts: DataFrame, on: Sequence[str], n: str, *, max_keys: int, min_rows: int
) -> DataFrame:
    """The most frequent keys, from a table with one row and a row count per key."""
    return (
        counts.where(F.col(n) >= min_rows)
        .orderBy(F.desc(n), *on)
        .limit(max_keys)
        .select(*on, F.lit(True).alias("_hot"))
    )


def salted_lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    *,
    counts: DataFrame,
    n: str,
    spread_by: Sequence[str],
    how: str = "left",
    max_keys: int = HOT_KEYS,
    min_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join facts to ``dim``, spreading each hot key over many tasks.

    Only rows of hot keys get a salt, and only their dim rows are repeated. (Rows with a
    NULL key match nothing and are spread as well.) The salt is a hash of ``spread_by``,
    so a retried task sends each row where it went before.
    """
    on = list(on)
    hot = F.broadcast(hot_keys(counts, on, n, max_keys=max_keys, min_rows=min_rows))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    salted_facts = facts.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, salt).otherwise(F.lit(0))
    )
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_dim = dim.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), all_salts).otherwise(F.array(F.lit(0))))
    )
    return (
        salted_facts.drop("_hot").join(salted_dim.drop("_hot"), [*on, "_salt"], how).drop("_salt")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    The filter on row number 1 lets Spark cut every map task's rows to one per key
    before the shuffle (WindowGroupLimit), so a hot key sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def running_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    *,
    name: str = "replicate_ix",
) -> DataFrame:
    """Number the rows of each key 1, 2, 3... in ``order``.

    ``bucket`` must grow with ``order``. Rows are numbered inside (key, bucket) and
    shifted by the row count of earlier buckets, which comes from a small aggregate;
    no task has to hold all rows of a hot key.
    """
    keys = list(keys)
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shifts = sizes.select(
        *keys, "_bucket", (F.sum("_n").over(earlier) - F.col("_n")).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return (
        rows.withColumn("_inside", inside)
        .join(shifts, [*keys, "_bucket"], "left")
        .withColumn(name, (F.col("_inside") + F.col("_shift")).cast("long"))
        .drop("_bucket", "_inside", "_shift")
    )
