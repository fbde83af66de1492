"""Ready reports over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def study_overview(
    studies: DataFrame,
    analyses: DataFrame,
    samples: DataFrame,
    features: DataFrame,
    measurements: DataFrame,
) -> DataFrame:
    """Samples, features and measurements per (study, analysis).

    Samples and measurements count per study, features per analysis. Features find
    their analysis by the prefix of their key: cut once, it is a plain equality. Each
    side is counted before any join, so no samples-times-features product arises, and
    measurements shrink to one row per sample before they move.
    """
    per_sample = measurements.groupBy("sample_uid").agg(F.count("*").alias("n"))
    per_study = (
        samples.join(per_sample, "sample_uid", "left")
        .groupBy("study_pk")
        .agg(F.count("*").alias("samples"), F.coalesce(F.sum("n"), F.lit(0)).alias("measurements"))
    )
    prefix = F.substring_index("feature_uid", ":", 1)
    per_analysis = (
        features.where(F.contains("feature_uid", F.lit(":")))
        .groupBy(prefix.alias("analysis_id"))
        .agg(F.count("*").alias("features"))
    )
    # two analyses of a study may share an id: they form one group
    pairs = analyses.select("study_pk", "analysis_id").distinct()
    out = (
        studies.join(pairs, "study_pk", "left")
        .join(per_study, "study_pk", "left")
        .join(per_analysis, "analysis_id", "left")
    )
    zero = F.lit(0)
    return out.select(
        "study_id",
        "analysis_id",
        F.coalesce("samples", zero).alias("samples"),
        F.coalesce("features", zero).alias("features"),
        F.coalesce("measurements", zero).alias("measurements"),
    )


def samples_of_study(
    samples: DataFrame, studies: DataFrame, study_id: str, limit: int = 10
) -> DataFrame:
    study = studies.where(F.col("study_id") == study_id).select("study_pk")
    found = samples.join(study, "study_pk", "left_semi")
    return found.select("sample_uid", "sample_label", "factors_raw").orderBy("sample_uid").limit(limit)


def features_of_analysis(features: DataFrame, analysis_id: str, limit: int = 10) -> DataFrame:
    found = features.where(F.startswith("feature_uid", F.lit(f"{analysis_id}:")))
    return found.select("feature_uid", "name_raw", "feature_type").orderBy("feature_uid").limit(limit)


def measurements_of_sample(
    measurements: DataFrame, features: DataFrame, sample_uid: str
) -> DataFrame:
    rows = measurements.where(F.col("sample_uid") == sample_uid)
    return (
        rows.join(features, "feature_uid")
        .select("name_raw", "value", "unit")
        .orderBy(F.asc_nulls_last("name_raw"))
    )


def measurements_per_study(
    measurements: DataFrame, samples: DataFrame, studies: DataFrame
) -> DataFrame:
    """Counted per sample first: one row per sample reaches the joins."""
    per_sample = measurements.groupBy("sample_uid").agg(F.count("*").alias("n"))
    return (
        samples.select("sample_uid", "study_pk")
        .join(per_sample, "sample_uid")
        .groupBy("study_pk")
        .agg(F.sum("n").alias("n"))
        .join(studies, "study_pk")
        .groupBy("study_id")
        .agg(F.sum("n").alias("measurement_count"))
    )


def latest_files(files: DataFrame, detected_type: str, limit: int = 20) -> DataFrame:
    found = files.where(F.col("detected_type") == detected_type)
    return (
        found.select("file_id", "filename", "detected_type", "created_at")
        .orderBy(F.desc_nulls_first("created_at"), "file_id")
        .limit(limit)
    )


def exported_where(exported: DataFrame, *columns: str, **equals: str) -> DataFrame:
    """Filter and project exported rows; both reach the Parquet scan."""
    for column, value in equals.items():
        exported = exported.where(F.col(column) == value)
    return exported.select(*columns) if columns else exported


def means_by_sample_type(exported: DataFrame) -> DataFrame:
    return exported.groupBy("sample_type").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean_value")
    )
