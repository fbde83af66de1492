"""Loading parsed files into a bucketed store, whole batches at a time.

A batch reads the buckets that its keys lie in, merges there, writes what changed, and commits
everything under its name. A batch whose name the store has is left alone, so a job that is
repeated after a failure, or a stream that replays a batch, changes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.keys import row_id
from assayframe.operators import merge
from assayframe.plans import ingest, parse
from assayframe.session import shared_folder
from assayframe.sources.files import read_lines, types_of_lines
from assayframe.sources.store import Segment, Store
from assayframe.sources.tables import settle


@dataclass
class JobStats:
    """Counters of a load, taken while rows were written."""

    files_total: int = 0
    files_parsed: int = 0
    files_success: int = 0
    files_failed: int = 0
    files_skipped: int = 0
    samples_created: int = 0
    features_created: int = 0
    measurements_inserted: int = 0
    warnings_count: int = 0
    by_type: dict[str, int] = field(default_factory=dict)
    commit: int | None = None  # null: the store had this batch

    def row(self, spark: SparkSession) -> DataFrame:
        """The counters as (counter, n), types as ``type <name>``."""
        rows = [(f.name, getattr(self, f.name)) for f in fields(self) if f.name not in ("by_type", "commit")]
        rows += [(f"type {name}", n) for name, n in sorted(self.by_type.items())]
        return spark.createDataFrame(rows, "counter string, n long")


def touched(store: Store, parsed: parse.Parsed) -> dict[str, list[int]]:
    """The buckets of each table that a parsed set may change or must be compared with."""
    good = parsed.metadata.where("error IS NULL").select(
        "file_id", "study_id", row_id(F.col("study_id")).alias("study_pk")
    )
    cells = parsed.measurements.where("known").select("sample_uid", "file_id")
    measurements = store.buckets_of("measurements", cells.select("sample_uid"))
    # a file whose cells were stored under other samples is compared with those too
    known = store.read("file_buckets", store.buckets_of("file_buckets", good))
    held = known.join(good.select("file_id").distinct(), "file_id", "left_semi")
    elsewhere = [r["held"] for r in held.select("held").distinct().collect()]
    return {
        "studies": store.buckets_of("studies", good),
        "analyses": store.buckets_of("analyses", good),
        "samples": store.buckets_of("samples", parsed.samples),
        "features": store.buckets_of("features", parsed.features),
        "measurements": sorted({*measurements, *elsewhere}),
    }


def changed_segments(
    store: Store, parsed: parse.Parsed, created_at=None
) -> tuple[list[Segment], dict[str, int]]:
    """Segments with what a parsed set changes, not committed, and the counts of what is new."""
    near = {name: store.read(name, buckets) for name, buckets in touched(store, parsed).items()}
    changes = parse.Changes(parsed, near, created_at)
    out, n = [], {}
    segments, _ = store.write("studies", changes.new_studies)
    out += segments
    segments, _ = store.change("analyses", settle(changes.analyses, "analyses"))
    out += segments
    segments, n["samples_created"] = store.change("samples", settle(changes.samples, "samples"))
    out += segments
    out += _features(store, changes, n)
    out += _measurements(store, changes, near["measurements"], n)
    return out, n


def _features(store: Store, changes: parse.Changes, n: dict[str, int]) -> list[Segment]:
    """New features, and buckets with a name that a plain file filled."""
    filled = settle(changes.filled_features, "filled")
    new = settle(changes.new_features.withColumn("_action", F.lit(merge.INSERT)), "new-features")
    anew = store.buckets_of("features", filled)
    state = new
    if anew:  # the buckets that hold filled names, whole
        rest = store.read("features", anew).join(filled, "feature_uid", "left_anti")
        state = new.unionByName(filled).unionByName(rest.withColumn("_action", F.lit(merge.KEEP)))
        state = settle(state, "features")
    segments, n["features_created"] = store.change("features", state)
    return segments


def _measurements(
    store: Store, changes: parse.Changes, stored: DataFrame, n: dict[str, int]
) -> list[Segment]:
    """Appended rows of strict files; buckets that plain files updated are written anew."""
    place = store.bucket("measurements")
    new = settle(changes.new_measurements, "new-measurements")
    plain = store.buckets_of("measurements", changes.parsed.plain("measurements").where("known"))
    added, state = new.withColumn("_action", F.lit(merge.INSERT)), None
    if plain:
        base = stored.where(place.isin(plain)).withColumn("_new", F.lit(False)).unionByName(
            new.where(place.isin(plain)).withColumn("_new", F.lit(True))
        )
        state = changes.measurements_on(base.drop("_new"))
        fresh = base.where("_new").select("sample_uid", "feature_uid", F.lit(True).alias("_new"))
        # rows of this batch that a plain file updated are still new to the store
        state = state.join(fresh, ["sample_uid", "feature_uid"], "left")
        was = F.when(F.col("_new"), F.lit(merge.INSERT)).otherwise(F.col("_action"))
        state = settle(state.withColumn("_action", was).drop("_new"), "measurements")
        added = added.where(~place.isin(plain)).unionByName(state)
    segments, n["measurements_inserted"] = store.change("measurements", added)
    pairs = added.where((F.col("_action") == merge.INSERT) & F.col("file_id").isNotNull())
    index, _ = store.write(
        "file_buckets", pairs.select("file_id", place.alias("held")).distinct()
    )
    return segments + index


def load(
    store: Store,
    chosen: DataFrame,
    parsed: parse.Parsed,
    batch: str,
    *,
    created_at=None,
    statuses: bool = False,
) -> JobStats:
    """Merge parsed files into the store as one commit named ``batch``.

    ``chosen``: file_id and detected_type of all files of the batch. With ``statuses`` the registry
    of the store gets their outcomes in the same commit.
    """
    stats = JobStats()
    if store.has(batch):
        return stats
    folder = shared_folder(store.spark, "parsed")
    parsed = parse.StoredParsed(parsed, folder)
    outcomes = settle(parse.outcome(chosen, parsed.metadata), "outcomes")
    totals = parse.outcome_stats(outcomes).first().asDict()
    for name, value in totals.items():
        setattr(stats, name, value)
    stats.files_parsed = stats.files_success + stats.files_failed
    stats.by_type = {r["detected_type"]: r["n"] for r in parse.parsed_by_type(outcomes).collect()}
    stats.warnings_count = parsed.warnings.count()
    segments, counts = changed_segments(store, parsed, created_at)
    for name, value in counts.items():
        setattr(stats, name, value)
    if statuses:
        at = created_at or F.current_timestamp()
        rows = store.read("files").join(outcomes.select("file_id"), "file_id", "left_semi")
        near = store.read("files", store.buckets_of("files", rows))
        new, _ = store.write("files", parse.with_status(near, outcomes, at), replaces=True)
        segments += new
    stats.commit = store.commit(segments, batch)
    return stats


def ingest_into(
    store: Store, root: str, import_id: str, *, created_at=None, **options
) -> ingest.IngestReport:
    """Scan a directory and register its new files; an import that the store has is left alone.

    New contents are told from known ones by the buckets of the registry that their hashes lie in.
    """
    batch = f"import {import_id}"
    if store.has(batch):
        return ingest.IngestReport(import_id, root, status="known")

    def known(candidates: DataFrame) -> DataFrame:
        return store.read("files", store.buckets_of("files", candidates))

    report = ingest.ingest_directory(
        store.spark, root, import_id, known, created_at=created_at, **options
    )
    if report.added is not None:
        files, _ = store.write("files", report.added)
        row = [(import_id, created_at, report.status, root, report.notes)]
        shape = "import_id string, created_at timestamp, status string, root_path string, notes string"
        imports = store.spark.createDataFrame(row, shape)
        imports = imports.withColumn("created_at", F.coalesce("created_at", F.current_timestamp()))
        log, _ = store.write("imports", imports)
        store.commit([*files, *log], batch)
    return report


def parse_pending(
    store: Store,
    texts: DataFrame | Callable[[DataFrame], DataFrame],
    import_id: str,
    batch: str,
    *,
    only_types: Iterable[str] | None = None,
    skip_types: Iterable[str] | None = None,
    max_files: int | None = None,
    created_at=None,
    large_bytes: int = parse.LARGE_BYTES,
) -> JobStats:
    """Parse an import's pending and failed files into the store; their outcomes are stored with it.

    ``texts`` has (path_abs, content) of the files; they are read once. It may be a function that gets the
    files to parse (file_id, detected_type, path, size_bytes) and returns these with their ``content``, as
    ``read_texts`` does: then no text moves to meet its id. Files over ``large_bytes`` are read line by
    line instead and need no row there.
    """
    if store.has(batch):
        return JobStats()
    pending = parse.pending_files(store.read("files"), import_id, only_types, skip_types, max_files)
    chosen = settle(pending.select("file_id", "detected_type", "path_abs", "size_bytes"), "pending")
    is_large = F.col("size_bytes") > large_bytes
    small = chosen.where(~is_large)
    if callable(texts):
        named = small.where("path_abs IS NOT NULL").withColumnRenamed("path_abs", "path")
        found = texts(named)
    else:
        found = parse.with_ids(texts, small, "path_abs")
    found = found.select("file_id", "detected_type", "content")
    files = parse.routed(parse.with_layout(found, F.col("content")))
    lines = weights = None
    large = chosen.where(is_large)
    if not large.isEmpty():
        listed = large.select(F.col("path_abs").alias("path"), "size_bytes")
        by_path = read_lines(store.spark, listed=listed).withColumnRenamed("file_id", "path_abs")
        lines = by_path.join(large.select("path_abs", "file_id"), "path_abs").drop("path_abs")
        layouts = settle(types_of_lines(lines).select("file_id", "layout"), "large-layouts")
        known = parse.with_layout(large.join(layouts, "file_id"), F.lit(None), F.col("layout"))
        lines = lines.join(known.select("file_id", "layout"), "file_id")
        weights = large.select("file_id", (F.col("size_bytes") / 64).alias("n"))
    return load(
        store,
        chosen.select("file_id", "detected_type"),
        parse.Parsed(files, "layout", lines=lines, weights=weights),
        batch,
        created_at=created_at,
        statuses=True,
    )
