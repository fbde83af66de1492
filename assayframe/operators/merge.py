"""Idempotent merges: get-or-create, fill, replace, coalesce-upsert, insert-first.

A batch is first cut to one row per key with aggregates that combine on the map
side, so both sides of every merge join are unique on the key and cannot be skewed.
Insert-only merges return just the rows to append; the store is never rewritten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.text import last_pair_per_key, factor_pairs
from assayframe.operators.skew import keep_first, salted_lookup

INSERT, UPDATE, SKIP, KEEP = "insert", "update", "skip", "keep"


def _filled(c: Column) -> Column:
    """NULL for an empty text."""
    return F.nullif(c.cast("string"), F.lit(""))


# How a stored value and a new value combine when the key exists on both sides.
RULES = {
    "keep": lambda old, new: old,
    "fill_null": lambda old, new: F.coalesce(old, new),
    "fill_empty": lambda old, new: F.coalesce(_filled(old), _filled(new), old),
    "replace_filled": lambda old, new: F.coalesce(_filled(new), old),
    "latest": lambda old, new: F.coalesce(new, old),
}

# How several rows of one key inside a batch become one.
PICKS = {
    "first": lambda c, order: F.min_by(c, order),
    "last": lambda c, order: F.max_by(c, order),
    "first_non_null": lambda c, order: F.min_by(c, F.when(c.isNotNull(), order)),
    "last_non_null": lambda c, order: F.max_by(c, F.when(c.isNotNull(), order)),
    "first_filled": lambda c, order: F.min_by(c, F.when(_filled(c).isNotNull(), order)),
    "last_filled": lambda c, order: F.max_by(c, F.when(_filled(c).isNotNull(), order)),
}


def reduce_batch(
    batch: DataFrame, keys: Sequence[str], picks: Mapping[str, str], order: Sequence[str]
) -> DataFrame:
    """One row per key; ``picks`` names the rule for every other column."""
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return batch.groupBy(*keys).agg(
        *[PICKS[rule](F.col(c), rank).alias(c) for c, rule in picks.items()]
    )


def merge(
    store: DataFrame, batch: DataFrame, keys: Sequence[str], rules: Mapping[str, str]
) -> DataFrame:
    """New state of the store, with ``_action`` insert / update / skip / keep per row.

    Both sides must be unique on ``keys``. To merge into a large partitioned store,
    pass only the partitions the batch touches and overwrite those.
    """
    keys = list(keys)
    old = store.select(*keys, F.struct(*rules).alias("_old"), F.lit(True).alias("_stored"))
    new = batch.select(*keys, F.struct(*rules).alias("_new"), F.lit(True).alias("_given"))
    both = old.join(new, keys, "full_outer")
    inserted, untouched = F.col("_stored").isNull(), F.col("_given").isNull()

    def merged(column: str, rule: str) -> Column:
        was, now = F.col("_old")[column], F.col("_new")[column]
        return F.when(inserted, now).when(untouched, was).otherwise(RULES[rule](was, now))

    state = both.select(
        "*", F.struct(*[merged(c, r).alias(c) for c, r in rules.items()]).alias("_state")
    )
    changed = F.lit(False)
    for c in rules:
        changed = changed | ~F.col("_old")[c].eqNullSafe(F.col("_state")[c])
    action = (
        F.when(inserted, INSERT)
        .when(untouched, KEEP)
        .when(changed, UPDATE)
        .otherwise(SKIP)
    )
    return state.select(*keys, *[F.col("_state")[c].alias(c) for c in rules], action.alias("_action"))


def new_rows(
    store: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Get-or-create / insert-ignore: the first row per key that the store lacks."""
    return keep_first(batch, keys, order).join(store.select(*keys), list(keys), "left_anti")


def insert_first(store: DataFrame, batch: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Measurements to append: first wins, under the file key and the sample key.

    A row is skipped when its (file, column, feature) is stored, when its
    (sample, feature) is stored, or when an earlier row of the batch has that pair.
    Rows without a file have no file key.
    """
    cell, pair = ["file_id", "col_index", "feature_uid"], ["sample_uid", "feature_uid"]
    stored_cells = store.where(F.col("file_id").isNotNull()).select(*cell)
    unseen = batch.join(stored_cells, cell, "left_anti")
    return keep_first(unseen, pair, order).join(store.select(*pair), pair, "left_anti")


def coalesce_upsert(
    store: DataFrame, batch: DataFrame, order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Measurements where the last non-null value and unit win over what is stored.

    ``keep`` names further columns of the store; inserted rows have NULL there.
    """
    pair, values = ["sample_uid", "feature_uid"], ["value", "unit"]
    once = reduce_batch(batch, pair, dict.fromkeys(values, "last_non_null"), order)
    once = once.withColumns(
        {c: F.lit(None).cast(store.schema[c].dataType) for c in keep}
    )
    rules = dict.fromkeys(values, "latest") | dict.fromkeys(keep, "keep")
    return merge(store, once, pair, rules)


def keep_latest(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Keep the row with the largest sequence per key; rows with a NULL key all stay."""
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    own_group = F.when(no_key, F.col(sequence))  # each such row forms a group of its own
    marked = df.withColumn("_own", own_group)
    return keep_first(marked, [*keys, "_own"], [F.desc(sequence)]).drop("_own")


def mark_first_seen(
    files: DataFrame,
    *,
    keys: Sequence[str] = ("sha256", "size_bytes"),
    order: str = "path_abs",
    id_column: str = "file_id",
    carry: Sequence[str] = (),
    registry: DataFrame | None = None,
    **skew: int,
) -> DataFrame:
    """Flag copies: adds ``canonical_id``, ``is_new`` and ``canonical_<c>`` for ``carry``.

    The first row of each content is new unless the registry holds that content; all
    others point to the row they repeat. One content may make up most of the rows:
    the first is found by an aggregate, and the way back is a salted join. ``files`` is
    read several times: pass stored fingerprints, not a plan that hashes contents.
    """
    keys, told = list(keys), [id_column, *carry]
    first = files.groupBy(*keys).agg(
        F.min_by(F.struct(*told), F.struct(order, id_column)).alias("_first"),
        F.count("*").alias("_n"),
    )
    dim = first.select(*keys, "_first")
    if registry is None:
        dim = dim.withColumn("_known", F.lit(None).cast(dim.schema["_first"].dataType))
    else:
        known = registry.select(*keys, F.struct(*told).alias("_known"))
        dim = dim.join(known, keys, "left")
    flagged = salted_lookup(
        files, dim, keys, counts=first, n="_n", spread_by=[id_column], **skew
    )
    source = F.coalesce("_known", "_first")
    is_new = F.col("_known").isNull() & (F.col(id_column) == F.col("_first")[id_column])
    return flagged.withColumns(
        {
            "canonical_id": source[id_column],
            "is_new": is_new,
            **{f"canonical_{c}": source[c] for c in carry},
        }
    ).drop("_first", "_known")


def sample_factors(samples: DataFrame) -> DataFrame:
    """Long factors of each sample: (sample_uid, factor_key, factor_value), last of a key wins."""
    pairs = last_pair_per_key(factor_pairs(F.col("factors_raw")))
    return samples.select("sample_uid", F.explode(pairs).alias("_p")).select(
        "sample_uid",
        F.col("_p.key").alias("factor_key"),
        F.col("_p.value").alias("factor_value"),
    )


def merge_factors(store: DataFrame, factors: DataFrame) -> DataFrame:
    """Upsert long factors on (sample_uid, factor_key); the new value replaces the old."""
    return merge(store, factors, ["sample_uid", "factor_key"], {"factor_value": "latest"})


def merge_stats(merged: DataFrame) -> DataFrame:
    """One row: processed, created, updated, skipped."""
    touched = F.col("_action") != KEEP
    return merged.agg(
        F.count_if(touched).alias("processed"),
        F.count_if(F.col("_action") == INSERT).alias("created"),
        F.count_if(F.col("_action") == UPDATE).alias("updated"),
        F.count_if(F.col("_action") == SKIP).alias("skipped"),
    )


def valid_rows(df: DataFrame, column: str, domain: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose status lies in the domain, rejected rows). NULL is rejected."""
    ok = F.coalesce(F.col(column).isin(*domain), F.lit(False))
    return df.where(ok), df.where(~ok)
