"""Ingest: a directory of files into the registry, and the import log."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.filetypes import EXTENSIONS, is_allowed_extension
from assayframe.operators.merge import mark_first_seen
from assayframe.schemas import IMPORT_STATUSES
from assayframe.sources import files as source
from assayframe.sources.tables import settle


def compare_with_registry(candidates: DataFrame, registry: DataFrame | None, **skew: int) -> DataFrame:
    """Candidates flagged ``is_new``; copies carry type and extension of what they repeat."""
    return mark_first_seen(
        candidates, carry=["detected_type", "ext"], registry=registry, **skew
    )


def new_files(flagged: DataFrame) -> DataFrame:
    """Rows to append to the registry."""
    extra = ("canonical_id", "canonical_detected_type", "canonical_ext", "is_new")
    return flagged.where("is_new").drop(*extra)


def import_counts(flagged: DataFrame, *by: str) -> DataFrame:
    """Files processed, new and duplicate (per group when asked)."""
    return flagged.groupBy(*by).agg(
        F.count("*").alias("files_processed"),
        F.count_if("is_new").alias("files_new"),
        F.count_if(~F.col("is_new")).alias("files_duplicate"),
    )


def counts_by(flagged: DataFrame, what: str) -> DataFrame:
    """File counts by ``detected_type`` or ``ext``, as the registry has them."""
    return flagged.groupBy(F.col(f"canonical_{what}").alias(what)).agg(F.count("*").alias("n"))


def with_outcome(counts: DataFrame, user_notes: str | None = None, errors: str | None = None) -> DataFrame:
    """Final status and notes of an import from its counts. An import has failed when
    files were in error and none was new."""
    n_errors = F.col(errors) if errors else F.lit(0)
    as_text = lambda c: F.col(c).cast("string")
    clean = F.concat(as_text("files_new"), F.lit(" new, "), as_text("files_duplicate"), F.lit(" duplicates"))
    broken = F.concat(
        as_text("files_new"),
        F.lit(" new, "),
        as_text("files_duplicate"),
        F.lit(" dup, "),
        n_errors.cast("string"),
        F.lit(" errors"),
    )
    notes = F.when(n_errors > 0, broken).otherwise(clean)
    if user_notes:
        notes = F.concat(F.lit(f"{user_notes}; "), notes)
    failed = (n_errors > 0) & (F.col("files_new") == 0)
    status = F.when(failed, F.lit("failed")).otherwise(F.lit("success"))
    return counts.withColumns({"status": status, "notes": notes})


@dataclass
class IngestReport:
    """Counts of one ingest, and the rows that the registry gains."""

    import_id: str
    root_path: str
    files_found: int = 0
    files_processed: int = 0
    files_new: int = 0
    files_duplicate: int = 0
    files_skipped: int = 0
    files_error: int = 0
    status: str = "success"
    notes: str = ""
    by_type: dict[str, int] = field(default_factory=dict)
    by_extension: dict[str, int] = field(default_factory=dict)
    added: DataFrame | None = None
    errors: DataFrame | None = None  # (path_abs, filename, ext, size_bytes) of unreadable files


def ingest_directory(
    spark: SparkSession,
    root: str,
    import_id: str,
    registry: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    *,
    user_notes: str | None = None,
    extensions: Iterable[str] = EXTENSIONS,
    max_files: int | None = None,
    dry_run: bool = False,
    row_bytes: int = source.ROW_BYTES,
    created_at=None,
) -> IngestReport:
    """Scan, fingerprint, compare. The caller appends ``added`` to its registry table.

    ``registry`` may be a function that gets the fingerprints and returns the part of the registry
    that can hold their contents.

    Files over ``row_bytes`` are streamed through their hash instead of loaded.

    A file that is gone or unreadable counts as ``files_error`` and does not stop the others.
    ``added`` has all columns of ``schemas.FILES``. A single file is ingested by passing its path as ``root``. Only counts reach the
    driver.
    """
    extensions = list(extensions)
    report = IngestReport(import_id, root)
    found = source.listing(spark, root)
    listed = source.described(found)
    wanted = is_allowed_extension(F.col("ext"), extensions)
    seen = listed.agg(
        F.count_if(wanted).alias("found"), F.count_if(~wanted).alias("skipped")
    ).first()
    report.files_found = min(seen["found"], max_files) if max_files else seen["found"]
    report.files_skipped = seen["skipped"]
    if dry_run:
        return report
    where: str | list[str] = root
    if max_files:  # the limit bounds the list of paths, and only those files are read
        first = source.choose_files(listed, extensions, max_files).select("path_abs")
        where = [r["path_abs"] for r in first.collect()]
        found = found.where(F.col("path").isin(where))
    # wanted by the caller but outside the fixed list: skipped, not registered
    allowed = is_allowed_extension(F.col("ext"))
    loaded = source.choose_files(source.read_files(spark, where, row_bytes, found), extensions)
    prints = source.with_fingerprint(loaded.where(allowed))
    due = source.choose_files(source.described(found), extensions).where(allowed)
    streamed = due.where(F.col("size_bytes") > row_bytes)
    if not streamed.isEmpty():
        prints = prints.unionByName(source.fingerprint_large(streamed))
    # contents are read and hashed once; all that follows uses the stored fingerprints
    rows = source.registry_rows(prints, import_id, root, created_at)
    candidates = settle(rows, "fingerprints")
    # what was listed and has no fingerprint is gone or cannot be read; the rest goes on
    report.errors = settle(due.join(candidates, "path_abs", "left_anti"), "errors")
    report.files_error = report.errors.count()
    known = registry if registry is None or isinstance(registry, DataFrame) else registry(candidates)
    flagged = settle(compare_with_registry(candidates, known), "compared")
    counts = import_counts(flagged).withColumn("files_error", F.lit(report.files_error))
    totals = with_outcome(counts, user_notes, "files_error").first()
    report.files_processed = totals["files_processed"]
    report.files_skipped += report.files_found - report.files_processed - report.files_error
    report.files_new, report.files_duplicate = totals["files_new"], totals["files_duplicate"]
    report.status, report.notes = totals["status"], totals["notes"]
    # one row per type / extension: both domains are fixed lists
    report.by_type = {r["detected_type"]: r["n"] for r in counts_by(flagged, "detected_type").collect()}
    report.by_extension = {r["ext"]: r["n"] for r in counts_by(flagged, "ext").collect()}
    report.added = new_files(flagged)
    return report


def import_event(
    spark: SparkSession,
    import_id: str,
    seq: int,
    status: str = "running",
    root_path: str | None = None,
    notes: str | None = None,
) -> DataFrame:
    """One row for the append-only import log: created, updated or finalized."""
    if status not in IMPORT_STATUSES:
        raise ValueError(f"status must be one of {', '.join(IMPORT_STATUSES)}, not {status!r}")
    return spark.createDataFrame(
        [(import_id, seq, status, root_path, notes)],
        "import_id string, seq long, status string, root_path string, notes string",
    )


def current_imports(log: DataFrame) -> DataFrame:
    """State of each import: the last status, the first root, the last notes given."""
    return log.groupBy("import_id").agg(
        F.min_by("root_path", "seq").alias("root_path"),
        F.max_by("status", "seq").alias("status"),
        F.max_by("notes", F.when(F.col("notes").isNotNull(), F.col("seq"))).alias("notes"),
    )


def import_files(
    registry: DataFrame, import_id: str, parse_status: str | None = None
) -> DataFrame:
    """Files of an import in order of creation."""
    found = registry.where(F.col("import_id") == import_id)
    if parse_status:
        found = found.where(F.col("parse_status") == parse_status)
    return found.orderBy("created_at", "file_id")
