"""Quality control over measurements: nulls, duplicates, special values, orphans, top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = ("sample_uid", "feature_uid")
NULL_UNIT = "<NULL>"
TOP = 10

# Thresholds of the grades, in percent.
NULLS_HIGH, NULLS_WARN, NEGATIVE_WARN, NO_FACTORS_WARN = 50, 20, 10, 50


def of_study(samples: DataFrame, studies: DataFrame, study_id: str) -> DataFrame:
    study = studies.where(F.col("study_id") == study_id).select("study_pk")
    return samples.join(study, "study_pk", "left_semi")


def filter_measurements(
    measurements: DataFrame,
    samples: DataFrame,
    studies: DataFrame | None,
    study_id: str | None = None,
    analysis_id: str | None = None,
) -> DataFrame:
    """Measurements of a study (through its samples) and of an analysis (by key prefix)."""
    chosen = measurements
    if analysis_id:
        chosen = chosen.where(F.startswith("feature_uid", F.lit(f"{analysis_id}:")))
    if study_id:
        wanted = of_study(samples, studies, study_id).select("sample_uid")
        chosen = chosen.join(wanted, "sample_uid", "left_semi")
    return chosen


def filter_samples(
    samples: DataFrame, studies: DataFrame | None, study_id: str | None = None
) -> DataFrame:
    return of_study(samples, studies, study_id) if study_id else samples


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def _value_counts() -> dict[str, Column]:
    v = F.col("value")
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    return {
        "total_measurements": F.count("*"),
        "non_null_values": F.count(v),
        "nan_count": F.count_if(F.isnan(v)),
        "pos_inf_count": F.count_if(v == high),
        "neg_inf_count": F.count_if(v == low),
        "negative_values_count": F.count_if((v < 0) & (v != low)),
    }


def value_counts(measurements: DataFrame) -> DataFrame:
    """Totals, nulls, special and negative values, all in one scan of one column."""
    counted = measurements.agg(*[c.alias(n) for n, c in _value_counts().items()])
    nulls = F.col("total_measurements") - F.col("non_null_values")
    return counted.withColumn("null_count", nulls).withColumn(
        "null_percent", _percent(F.col("null_count"), F.col("total_measurements"))
    )


def duplicate_pairs(measurements: DataFrame) -> DataFrame:
    """One row: (sample, feature) pairs that occur more than once."""
    pairs = measurements.groupBy(*PAIR).agg(F.count("*").alias("n")).where("n > 1")
    return pairs.agg(F.count("*").alias("duplicate_pairs_count"))


def orphans(measurements: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the dimension lacks. Keys are made distinct before the join,
    so a key with very many measurements crosses the network once per task."""
    used = measurements.where(F.col(key).isNotNull()).select(key).distinct()
    return used.join(dim.select(key), key, "left_anti")


def orphan_count(measurements: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    return orphans(measurements, dim, key).agg(F.count("*").alias(name))


def top_units(measurements: DataFrame, limit: int = TOP) -> DataFrame:
    counted = measurements.groupBy("unit").agg(F.count("*").alias("n"))
    shown = counted.select(F.coalesce("unit", F.lit(NULL_UNIT)).alias("unit"), "n")
    return shown.orderBy(F.desc("n"), "unit").limit(limit)


def top_null_features(measurements: DataFrame, limit: int = TOP) -> DataFrame:
    nulls = measurements.where(F.col("value").isNull())
    counted = nulls.groupBy("feature_uid").agg(F.count("*").alias("null_count"))
    return counted.orderBy(F.desc("null_count"), "feature_uid").limit(limit)


def sample_counts(samples: DataFrame) -> DataFrame:
    return samples.agg(
        F.count("*").alias("samples_total"),
        F.count_if(F.col("factors_raw").isNull()).alias("samples_no_factors"),
    )


COUNTERS = (
    "total_measurements",
    "non_null_values",
    "nan_count",
    "pos_inf_count",
    "neg_inf_count",
    "negative_values_count",
)


def key_counts(measurements: DataFrame) -> DataFrame:
    """Counters of every sample and of every feature, from one scan.

    One aggregate by (sample, feature) carries all counters, and which pairs occur more than once.
    It is then summed by sample and by feature; ``of_sample`` tells which a row is about.
    """
    pairs = measurements.groupBy(*PAIR).agg(*[c.alias(n) for n, c in _value_counts().items()])
    either = F.array(
        F.struct(F.lit(True).alias("of_sample"), F.col("sample_uid").alias("key")),
        F.struct(F.lit(False).alias("of_sample"), F.col("feature_uid").alias("key")),
    )
    repeated = F.count_if(F.col("total_measurements") > 1).alias("duplicate_pairs_count")
    return (
        pairs.select(*COUNTERS, F.inline(either))
        .groupBy("of_sample", "key")
        .agg(repeated, *[F.sum(c).alias(c) for c in COUNTERS])
    )


def fact_counts(measurements: DataFrame, samples: DataFrame, features: DataFrame) -> DataFrame:
    """One row: all counters of the measurements, duplicate pairs and orphans of both kinds."""
    keys = key_counts(measurements)
    known_samples = samples.select(
        F.col("sample_uid").alias("key"), F.lit(True).alias("of_sample"), F.lit(True).alias("_known")
    )
    known_features = features.select(
        F.col("feature_uid").alias("key"), F.lit(False).alias("of_sample"), F.lit(True).alias("_known")
    )
    found = keys.join(known_samples.unionByName(known_features), ["of_sample", "key"], "left")
    orphan = F.col("key").isNotNull() & F.col("_known").isNull()
    of_sample = F.col("of_sample")

    def total(counter: str) -> Column:
        return F.coalesce(F.sum(F.when(of_sample, F.col(counter))), F.lit(0)).alias(counter)

    return found.agg(
        *[total(c) for c in (*COUNTERS, "duplicate_pairs_count")],
        F.count_if(of_sample & orphan).alias("orphan_sample_count"),
        F.count_if(~of_sample & orphan).alias("orphan_feature_count"),
    )


def summary(
    measurements: DataFrame,
    samples: DataFrame,
    features: DataFrame,
    studies: DataFrame | None = None,
    study_id: str | None = None,
    analysis_id: str | None = None,
) -> DataFrame:
    """All metrics in one row, for everything or for a study and / or an analysis.

    The measurements are scanned once. Orphans are looked for in all samples, whatever the
    filter; the sample counts are those of the study. Keys of ``samples`` and ``features`` are unique.
    """
    rows = filter_measurements(measurements, samples, studies, study_id, analysis_id)
    facts = fact_counts(rows, samples, features)
    about = sample_counts(filter_samples(samples, studies, study_id))
    both = facts.unionByName(about, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    nulls = F.col("total_measurements") - F.col("non_null_values")
    return one.withColumn("null_count", nulls).withColumn(
        "null_percent", _percent(F.col("null_count"), F.col("total_measurements"))
    )


def graded(summary_row: DataFrame) -> DataFrame:
    """The report: (metric, value, status) rows."""
    ok, warn, issue = F.lit("OK"), F.lit("WARN"), F.lit("ISSUE")
    none = F.lit("")
    c = F.col
    total, nulls = c("total_measurements"), c("null_percent")
    negative = _percent(c("negative_values_count"), total)
    bare = _percent(c("samples_no_factors"), c("samples_total"))
    grades = {
        "total_measurements": F.when(total > 0, ok).otherwise(F.lit("EMPTY")),
        "non_null_values": none,
        "null_count": F.when(nulls > NULLS_HIGH, F.lit("HIGH"))
        .when(nulls > NULLS_WARN, warn)
        .otherwise(ok),
        "duplicate_pairs_count": F.when(c("duplicate_pairs_count") == 0, ok).otherwise(issue),
        "nan_count": F.when(c("nan_count") == 0, ok).otherwise(warn),
        "pos_inf_count": F.when(c("pos_inf_count") == 0, ok).otherwise(warn),
        "neg_inf_count": F.when(c("neg_inf_count") == 0, ok).otherwise(warn),
        "negative_values_count": F.when(negative > NEGATIVE_WARN, warn).otherwise(ok),
        "orphan_sample_count": F.when(c("orphan_sample_count") == 0, ok).otherwise(issue),
        "orphan_feature_count": F.when(c("orphan_feature_count") == 0, ok).otherwise(issue),
        "samples_total": none,
        "samples_no_factors": F.when(bare > NO_FACTORS_WARN, warn).otherwise(ok),
    }
    rows = [
        F.struct(F.lit(m).alias("metric"), c(m).alias("value"), g.alias("status"))
        for m, g in grades.items()
    ]
    return summary_row.select(F.inline(F.array(*rows)))


def issues(summary_row: DataFrame) -> DataFrame:
    """Texts of the critical findings; no rows when there are none."""
    c = F.col
    found = F.array(
        *[
            F.when(c(m) > 0, F.concat(c(m).cast("string"), F.lit(f" {what}")))
            for m, what in (
                ("duplicate_pairs_count", "duplicate pairs"),
                ("orphan_sample_count", "orphan samples"),
                ("orphan_feature_count", "orphan features"),
            )
        ],
        F.when(
            c("null_percent") > NULLS_HIGH,
            F.format_string("high NULL rate (%.1f%%)", c("null_percent")),
        ),
    )
    return summary_row.select(F.explode(F.array_compact(found)).alias("issue"))
