"""The derive job: device of files and analyses, exposure and matrix of samples, with one row of counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.operators import derive
from assayframe.sources.store import Segment, Store
from assayframe.sources.tables import settle

# Types of files whose text is searched for a device.
SEARCHED_TYPES = ("mwtab", "mwtab_ms", "text/plain")


@dataclass(frozen=True)
class Derived:
    """Rows that a derive job changed (none in a dry run), its counts and its warnings."""

    files: DataFrame
    analyses: DataFrame
    samples: DataFrame
    stats: DataFrame
    warnings: DataFrame


def _renamed(stats: DataFrame, table: str, subject: str) -> DataFrame:
    """Counts under their names in the report: of all rows by table, the others by subject, too."""
    return stats.select(
        *[
            F.col(c).alias(f"{table}_{c}" if c == "processed" else f"{table}_{subject}_{c}")
            for c in stats.columns
        ]
    )


def derive_all(
    tables: dict[str, DataFrame],
    texts: DataFrame | None = None,
    *,
    study_id: str | None = None,
    file_id: str | None = None,
    limit: int | None = None,
    dry_run: bool = False,
) -> Derived:
    """Derive what is empty in files, analyses and samples.

    ``file_id`` narrows the files, ``study_id`` the samples, ``limit`` both, in the order of their
    keys. ``texts`` (file_id, content) are searched for a device; a file without a text there counts
    as unreadable. A dry run counts what would be set and changes nothing.
    """
    files = tables["files"]
    if file_id:
        files = files.where(F.col("file_id") == file_id)
    if limit:
        files = files.orderBy("file_id").limit(limit)
    content = F.lit(None).cast("string")
    if texts is not None:
        searched = files.where(F.col("detected_type").isin(*SEARCHED_TYPES) & (F.coalesce("device", F.lit("")) == ""))
        found = texts.join(searched.select("file_id"), "file_id", "left_semi")
        # by a sort: Spark may take texts for small and broadcast them
        named = found.select("file_id", F.col("content").alias("_text")).hint("merge")
        files = files.join(named, "file_id", "left")
        content = F.col("_text")
    with_text = files.withColumn("_content", content)
    devices = derive.derive_device(with_text, "_content").drop("_content", "_text")
    devices = settle(devices, "devices")

    samples = derive.in_scope(tables["samples"], study_id, limit)
    stored = tables.get("sample_factors")
    exposed = derive.derive_exposure(samples, stored)
    matched = derive.derive_matrix(exposed, stored, tables["measurements"], tables["files"])
    matched = settle(matched, "samples")

    counts = [
        _renamed(derive.action_stats(devices, "device"), "files", "device"),
        _renamed(derive.action_stats(matched, "exposure", "exposure_conflict"), "samples", "exposure"),
        _renamed(derive.action_stats(matched, "matrix", "matrix_conflict"), "samples", "matrix").drop(
            "samples_processed"
        ),
    ]
    every = counts[0]
    for one in counts[1:]:
        every = every.unionByName(one, allowMissingColumns=True)
    stats = every.agg(*[F.max(c).alias(c) for c in every.columns])
    warnings = derive.conflict_warnings(matched, "exposure").unionByName(
        derive.conflict_warnings(matched, "matrix")
    )
    changed = F.lit(not dry_run)
    set_files = devices.where(changed & (F.col("device_action") == "set"))
    touched = tables["analyses"].join(set_files.select("file_id"), "file_id", "left_semi")
    analyses = derive.propagate_device(touched, set_files).select(tables["analyses"].columns)
    either = (F.col("exposure_action") == "set") | (F.col("matrix_action") == "set")
    return Derived(
        set_files.select(tables["files"].columns),
        analyses.where(changed),
        matched.where(changed & either).select(tables["samples"].columns),
        stats,
        warnings,
    )


def replaced(store: Store, table: str, key: str, rows: DataFrame) -> list[Segment]:
    """Segments with ``rows`` in the place of those with their keys; their buckets are rewritten."""
    rows = settle(rows, "replaced")
    near = store.read(table, store.buckets_of(table, rows))
    rest = near.join(rows.select(key), key, "left_anti").withColumn("_action", F.lit("keep"))
    state = settle(rest.unionByName(rows.withColumn("_action", F.lit("update"))), "state")
    return store.change(table, state)[0]


def derive_into(store: Store, batch: str, texts: DataFrame | None = None, **scope) -> Derived | None:
    """``derive_all`` over a store, as one commit named ``batch``; None if the store has it."""
    if store.has(batch):
        return None
    names = ("files", "analyses", "samples", "measurements", "sample_factors")
    done = derive_all(store.tables(*names), texts, **scope)
    segments = (
        replaced(store, "files", "file_id", done.files)
        + replaced(store, "analyses", "analysis_pk", done.analyses)
        + replaced(store, "samples", "sample_uid", done.samples)
    )
    store.commit(segments, batch)
    return done
