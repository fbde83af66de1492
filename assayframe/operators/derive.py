"""Deriving device, exposure and sample matrix.

Scores are per factor and summed per sample; sets of matrix classes are bit masks.
Both combine on the map side in a hash aggregate, so a sample or file with very many
rows costs its own tasks only a few bytes of shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions import devices
from assayframe.functions.text import factor_pairs, last_pair_per_key
from assayframe.operators.skew import keep_first


def _unset(c: Column) -> Column:
    return F.nullif(c, F.lit("")).isNull()


def derive_device(files: DataFrame, content: str | None = "content") -> DataFrame:
    """Adds ``device_action`` (set / already_set / unknown) and fills ``device``.

    ``content`` names the column with the file's text; None when it cannot be read.
    """
    text = F.col(content) if content else F.lit(None).cast("string")
    found = devices.device_of_file(
        F.col("path_abs"), F.col("filename"), F.col("detected_type"), text
    )
    unset = _unset(F.col("device"))
    checked = files.withColumn("_found", F.when(unset, found))
    action = (
        F.when(~unset, F.lit("already_set"))
        .when(F.col("_found").isNotNull(), F.lit("set"))
        .otherwise(F.lit("unknown"))
    )
    return (
        checked.withColumn("device_action", action)
        .withColumn("device", F.coalesce("_found", "device"))
        .drop("_found")
    )


def propagate_device(analyses: DataFrame, derived_files: DataFrame) -> DataFrame:
    """Fill the empty device of analyses from files whose device was just set."""
    fresh = derived_files.where(F.col("device_action") == "set").select(
        "file_id", F.col("device").alias("_device")
    )
    filled = F.when(_unset(F.col("device")), F.coalesce("_device", "device")).otherwise(
        F.col("device")
    )
    return analyses.join(fresh, "file_id", "left").withColumn("device", filled).drop("_device")


def raw_pairs(raw: Column) -> Column:
    """Factor pairs as derivation reads them: lower-case keys, last of a key wins."""
    return last_pair_per_key(factor_pairs(raw, lower_keys=True, keep_empty_keys=True))


def factor_signs(samples: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Adds ``ob``, ``con`` (scores) and ``mask`` (matrix classes) to each sample.

    From ``factors_raw`` alone this stays inside the row. With stored factors the pairs
    of both are laid over each other first: a raw pair replaces a stored one.
    """
    if stored is None:
        scored = samples.withColumn(
            "_signs",
            F.transform(
                F.transform(
                    raw_pairs(F.col("factors_raw")),
                    lambda p: devices.plain_factor(p["key"], p["value"]),
                ),
                _signs,
            ),
        )

        def total(field: str, combine) -> Column:
            return F.aggregate("_signs", F.lit(0), lambda acc, s: combine(acc, s[field]))

        return scored.withColumns(
            {
                "ob": total("ob", lambda a, b: a + b),
                "con": total("con", lambda a, b: a + b),
                "mask": total("mask", lambda a, b: a.bitwiseOR(b)),
            }
        ).drop("_signs")
    raw = samples.select(
        "sample_uid", F.explode(raw_pairs(F.col("factors_raw"))).alias("p")
    ).select(
        "sample_uid",
        F.col("p.key").alias("key"),
        F.col("p.value").alias("value"),
        F.lit(1).alias("layer"),
        F.col("p.key").alias("spelling"),
    )
    kept = stored.select(
        "sample_uid",
        F.lower("factor_key").alias("key"),
        F.col("factor_value").alias("value"),
        F.lit(0).alias("layer"),
        F.col("factor_key").alias("spelling"),
    )
    pairs = keep_first(
        raw.unionByName(kept), ["sample_uid", "key"], [F.desc("layer"), F.desc("spelling")]
    )
    plain = pairs.select(
        "sample_uid", devices.plain_factor(F.col("key"), F.col("value")).alias("factor")
    )
    signs = plain.select("sample_uid", _signs(F.col("factor")).alias("s"))
    totals = signs.groupBy("sample_uid").agg(
        F.sum("s.ob").cast("int").alias("ob"),
        F.sum("s.con").cast("int").alias("con"),
        F.bit_or("s.mask").alias("mask"),
    )
    return samples.join(totals, "sample_uid", "left").fillna(0, ["ob", "con", "mask"])


def _signs(factor: Column) -> Column:
    ob, con = devices.exposure_scores(factor)
    mask = devices.matrix_mask(factor)
    return F.struct(ob.alias("ob"), con.alias("con"), mask.alias("mask"))


def _settled(found: Column, column: str) -> tuple[Column, Column]:
    """(new value, action)"""
    unset = _unset(F.col(column))
    action = (
        F.when(~unset, F.lit("already_set"))
        .when(found.isNotNull(), F.lit("set"))
        .otherwise(F.lit("unknown"))
    )
    return F.when(unset, F.coalesce(found, F.col(column))).otherwise(F.col(column)), action


def derive_exposure(samples: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Fills ``exposure``; adds ``exposure_action`` and ``exposure_conflict``."""
    signed = factor_signs(samples, stored)
    ob, con = F.col("ob"), F.col("con")
    value, action = _settled(devices.exposure_of_scores(ob, con), "exposure")
    conflict = _unset(F.col("exposure")) & devices.exposure_conflict(ob, con)
    return (
        signed.withColumns({"exposure_conflict": conflict, "exposure_action": action})
        .withColumn("exposure", value)
        .drop("ob", "con", "mask")
    )


def file_masks(measurements: DataFrame, files: DataFrame) -> DataFrame:
    """(sample_uid, file_mask): matrix classes named by the paths of a sample's files."""
    pairs = measurements.where(F.col("file_id").isNotNull()).select("sample_uid", "file_id")
    named = files.select(
        "file_id", devices.matrix_mask_of_path(F.col("path_abs")).alias("_mask")
    ).where(F.col("_mask") != 0)
    hits = pairs.distinct().join(named, "file_id")
    return hits.groupBy("sample_uid").agg(F.bit_or("_mask").alias("file_mask"))


def derive_matrix(
    samples: DataFrame,
    stored: DataFrame | None = None,
    measurements: DataFrame | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Fills ``sample_matrix``; adds ``matrix_action`` and ``matrix_conflict``.

    File paths are used only where the factors name no class at all.
    """
    signed = factor_signs(samples, stored)
    conflict = devices.matrix_conflict(F.col("mask"))
    found = devices.matrix_of_mask(F.col("mask"))
    if measurements is not None and files is not None:
        signed = signed.join(file_masks(measurements, files), "sample_uid", "left")
        by_path = devices.matrix_of_mask(F.col("file_mask"))
        found = F.coalesce(found, F.when(~conflict, by_path))
    value, action = _settled(found, "sample_matrix")
    return (
        signed.withColumns(
            {"matrix_conflict": _unset(F.col("sample_matrix")) & conflict, "matrix_action": action}
        )
        .withColumn("sample_matrix", value)
        .drop("ob", "con", "mask", "file_mask")
    )


def in_scope(
    samples: DataFrame, study_id: str | None = None, limit: int | None = None
) -> DataFrame:
    """Samples of one study (by key prefix) and at most ``limit`` of them, in key order."""
    chosen = samples
    if study_id:
        chosen = chosen.where(F.startswith("sample_uid", F.lit(f"{study_id}:")))
    return chosen.orderBy("sample_uid").limit(limit) if limit else chosen


def action_stats(derived: DataFrame, subject: str, conflicts: str | None = None) -> DataFrame:
    """One row of counts for ``<subject>_action``."""
    action = F.col(f"{subject}_action")
    counts = [
        F.count("*").alias("processed"),
        F.count_if(action == "set").alias("set"),
        F.count_if(action == "already_set").alias("already_set"),
        F.count_if(action == "unknown").alias("unknown"),
    ]
    if conflicts:
        counts.append(F.count_if(conflicts).alias("conflict"))
    return derived.agg(*counts)


def conflict_warnings(derived: DataFrame, subject: str) -> DataFrame:
    text = F.concat(F.lit(f"{subject.capitalize()} conflict for sample "), F.col("sample_uid"))
    return derived.where(f"{subject}_conflict").select("sample_uid", text.alias("warning"))
