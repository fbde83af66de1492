"""Applying file tags to the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.functions.tags import all_tags

TAGS = ("device", "exposure", "sample_type", "platform")


def select_files(
    files: DataFrame,
    *,
    everything: bool = False,
    import_id: str | None = None,
    file_id: str | None = None,
) -> DataFrame:
    """The files to tag: one file, one import, or all. One of them must be asked for."""
    if file_id is not None:
        return files.where(F.col("file_id") == file_id)
    if import_id is not None:
        return files.where(F.col("import_id") == import_id)
    if everything:
        return files
    raise ValueError("choose the files to tag: file_id, import_id or everything")


def tag_files(files: DataFrame, *, overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """Files with tags applied, plus ``set_<tag>`` flags, ``updated`` and ``warnings``.

    A missing inference never erases a value. Without ``overwrite`` only NULL tags are
    filled, and a file with all tags is left alone. A dry run keeps the old values and
    still tells what would be set.
    """
    inferred = all_tags(F.col("path_rel"), F.col("filename"), F.col("detected_type"))
    tagged = files.withColumn("_tags", inferred)
    complete = F.lit(not overwrite)
    for tag in TAGS:
        complete = complete & F.col(tag).isNotNull()
    out = {}
    for tag in TAGS:
        found, old = F.col("_tags")[tag], F.col(tag)
        out[f"set_{tag}"] = found.isNotNull() & (F.lit(overwrite) | old.isNull())
        if not dry_run:
            out[tag] = F.coalesce(found, old) if overwrite else F.coalesce(old, found)
    out["warnings"] = F.when(complete, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.col("_tags.warnings"), lambda w: F.concat(F.col("filename"), F.lit(": "), w)
        )
    )
    tagged = tagged.withColumns(out).drop("_tags")
    updated = F.lit(False)
    for tag in TAGS:
        updated = updated | F.col(f"set_{tag}")
    return tagged.withColumn("updated", updated)


def tag_stats(tagged: DataFrame) -> DataFrame:
    """One row: files processed, updated, skipped, tags set, warnings."""
    return tagged.agg(
        F.count("*").alias("files_processed"),
        F.count_if("updated").alias("files_updated"),
        F.count_if(~F.col("updated")).alias("files_skipped"),
        *[F.count_if(f"set_{t}").alias(f"{t}_set") for t in TAGS],
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("warning_count"),
    )


def tag_warnings(tagged: DataFrame) -> DataFrame:
    return tagged.select("file_id", F.explode("warnings").alias("warning"))
