"""Parse jobs: choose files, parse them by layout, merge the result, record the outcome."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe import schemas
from assayframe.functions.filetypes import detected_type, filename_of
from assayframe.functions.keys import row_id
from assayframe.operators import merge, mwtab
from assayframe.operators.mwtab import LAYOUTS
from assayframe.operators.mwtab_lines import LineMatrices
from assayframe.session import shared_folder
from assayframe.sources.files import (
    line_weights,
    list_files,
    read_lines,
    read_texts,
    types_of_lines,
)
from assayframe.sources.tables import STORED_CODEC, settle

PARSABLE = tuple(LAYOUTS)
UNSUPPORTED = "Unsupported file type"
LARGE_BYTES = 256 * 1024 * 1024  # files beyond this are parsed line by line
BROADCAST_FILES = 100_000  # ids and layouts of files that every task may hold


# --- choosing files ---


def _asked_for(only_types: Iterable[str] | None, skip_types: Iterable[str] | None) -> Column:
    selected = F.lit(True)
    if only_types:
        selected = selected & F.col("detected_type").isin(*only_types)
    if skip_types:
        selected = selected & ~F.col("detected_type").isin(*skip_types)
    return selected


def parsable_files(
    files: DataFrame,
    only_types: Iterable[str] | None = None,
    skip_types: Iterable[str] | None = None,
) -> DataFrame:
    """Files of a directory that can be parsed, with ``selected``: false means filtered out."""
    parsable = files.where(F.col("detected_type").isin(*PARSABLE))
    return parsable.withColumn("selected", _asked_for(only_types, skip_types))


def pending_files(
    registry: DataFrame,
    import_id: str,
    only_types: Iterable[str] | None = None,
    skip_types: Iterable[str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files of an import still to parse or to retry, oldest first."""
    found = registry.where(F.col("import_id") == import_id).where(
        F.col("parse_status").isin("pending", "failed")
    )
    if only_types:
        found = found.where(F.col("detected_type").isin(*only_types))
    if skip_types:
        found = found.where(~F.col("detected_type").isin(*skip_types))
    found = found.orderBy("created_at", "file_id")
    return found.limit(max_files) if max_files else found


# --- parsing ---


class Parsed:
    """Lazy result of parsing files, every file by its own layout.

    ``files`` has file_id, content and ``layout_column``; files of other types are left
    out. All tables keep ``layout`` and ``file_id``. Files with missing ids give no
    rows; ``metadata`` tells why.
    """

    def __init__(
        self,
        files: DataFrame,
        layout_column: str = "detected_type",
        lines: DataFrame | None = None,
        weights: DataFrame | None = None,
    ):
        """``lines`` (file_id, no, text, <layout_column>) adds files too large for one row;
        ``weights`` (file_id, n) tells how large each of them is."""
        self._with_lines = lines is not None
        self._parts = {}
        for name, layout in LAYOUTS.items():
            chosen = F.col(layout_column) == name
            parts = [mwtab.Matrices(files.where(chosen), layout, need_ids=True)]
            if lines is not None:
                parts.append(LineMatrices(lines.where(chosen), layout, weights, need_ids=True))
            self._parts[name] = parts

    def _table(self, part, table: str) -> DataFrame:
        df = getattr(part, table)
        numbered = table in ("measurements", "marked", "warnings", "line_warnings")
        if self._with_lines and numbered and isinstance(part, mwtab.Matrices):
            # lines of split files are numbered by (split offset, place in split)
            place = F.struct(F.lit(0).cast("long").alias("offset"), F.col("line_no").cast("long").alias("at"))
            df = df.withColumn("line_no", place)
        return df

    def _union(self, table: str, names: Iterable[str] = PARSABLE) -> DataFrame:
        tables = [
            self._table(part, table).withColumn("layout", F.lit(name))
            for name in names
            for part in self._parts[name]
        ]
        return reduce(DataFrame.unionByName, tables)

    def strict(self, table: str) -> DataFrame:
        """A table for the strict layouts only."""
        return self._union(table, [n for n, layout in LAYOUTS.items() if layout.strict])

    def plain(self, table: str) -> DataFrame:
        return self._union(table, [mwtab.PLAIN.name])

    @cached_property
    def measurements(self) -> DataFrame:
        return self._union("measurements")

    @cached_property
    def samples(self) -> DataFrame:
        return self._union("samples")

    @cached_property
    def features(self) -> DataFrame:
        return self._union("features")

    @cached_property
    def metadata(self) -> DataFrame:
        return self._union("metadata")

    @cached_property
    def warnings(self) -> DataFrame:
        return self._union("warnings")


def routed(files: DataFrame, layout_column: str = "layout") -> DataFrame:
    """``files`` written once, by layout: the texts are scanned here and nowhere else.

    Every file keeps its row; the texts of files without a parsable layout are not written.
    Whoever reads one layout then reads its folder alone.
    """
    layout = F.when(F.col(layout_column).isin(*PARSABLE), F.col(layout_column))
    columns = ["file_id", "detected_type"] if "detected_type" in files.columns else ["file_id"]
    rows = files.select(
        *columns, F.when(layout.isNotNull(), F.col("content")).alias("content"), layout.alias("layout")
    )
    path = shared_folder(files.sparkSession, "texts")
    rows.write.option("compression", STORED_CODEC).partitionBy("layout").parquet(path)
    return files.sparkSession.read.schema(rows.schema).parquet(path)


class StoredParsed(Parsed):
    """A parse result written to a folder: every file is parsed once, whatever uses it.

    Pass ``routed`` files, or the texts are scanned once for each layout.
    """

    TABLES = ("marked", "samples", "features", "metadata", "line_warnings")

    def __init__(self, parsed: Parsed, folder: str):
        self._read = {}
        # the texts of each layout are read once; all tables come from what that left
        parsed._parts = {
            name: [mwtab.StoredMatrices(p) if isinstance(p, mwtab.Matrices) else p for p in parts]
            for name, parts in parsed._parts.items()
        }
        for name in self.TABLES:
            layouts = [mwtab.PLAIN.name] if name == "line_warnings" else PARSABLE
            for layout in layouts:  # each by itself: a write by partitions would sort its rows
                rows = parsed._union(name, [layout]).drop("layout")
                path = f"{folder}/{name}/layout={layout}"
                rows.write.option("compression", STORED_CODEC).parquet(path)
            schema = parsed._union(name, layouts).schema
            self._read[name] = rows.sparkSession.read.schema(schema).parquet(f"{folder}/{name}")
        # cells and their warnings come from one table
        self._read["measurements"] = self._read["marked"].drop("unreadable")
        cells = mwtab.warnings_of_cells(self._read["marked"])
        self._read["warnings"] = cells.unionByName(self._read["line_warnings"].drop("layout"))

    def _union(self, table: str, names: Iterable[str] = PARSABLE) -> DataFrame:
        return self._read[table].where(F.col("layout").isin(*names))

    @cached_property
    def warnings(self) -> DataFrame:
        return self._read["warnings"]


def outcome(chosen: DataFrame, metadata: DataFrame) -> DataFrame:
    """(file_id, detected_type, parse_status, parse_error) of every chosen file."""
    errors = metadata.select("file_id", "error")
    unsupported = ~F.col("detected_type").isin(*PARSABLE)
    status = (
        F.when(unsupported, F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("failed"))
        .otherwise(F.lit("success"))
    )
    error = F.when(unsupported, F.lit(UNSUPPORTED)).otherwise(F.col("error"))
    return (
        chosen.select("file_id", "detected_type")
        .join(errors, "file_id", "left")
        .select("file_id", "detected_type", status.alias("parse_status"), error.alias("parse_error"))
    )


def stop_on_failure(outcomes: DataFrame) -> None:
    """Raise for the first failed file, if any (the fail-fast option)."""
    failed = outcomes.where("parse_status = 'failed'").orderBy("file_id").take(1)
    if failed:
        raise RuntimeError(f"cannot parse {failed[0]['file_id']}: {failed[0]['parse_error']}")


def with_status(registry: DataFrame, outcomes: DataFrame, parsed_at) -> DataFrame:
    """Registry with new status, error and time for the parsed files."""
    new = outcomes.select(
        "file_id",
        F.col("parse_status").alias("_status"),
        F.col("parse_error").alias("_error"),
        F.lit(True).alias("_done"),
    )
    done = F.col("_done").isNotNull()
    return (
        registry.join(new, "file_id", "left")
        .withColumns(
            {
                "parse_status": F.when(done, F.col("_status")).otherwise(F.col("parse_status")),
                "parse_error": F.when(done, F.col("_error")).otherwise(F.col("parse_error")),
                "parsed_at": F.when(done, F.lit(parsed_at)).otherwise(F.col("parsed_at")),
            }
        )
        .drop("_status", "_error", "_done")
    )


def outcome_stats(outcomes: DataFrame) -> DataFrame:
    status = F.col("parse_status")
    return outcomes.agg(
        F.count("*").alias("files_total"),
        F.count_if(status == "success").alias("files_success"),
        F.count_if(status == "failed").alias("files_failed"),
        F.count_if(status == "skipped").alias("files_skipped"),
    )


def parsed_by_type(outcomes: DataFrame) -> DataFrame:
    done = outcomes.where("parse_status = 'success'")
    return done.groupBy("detected_type").agg(F.count("*").alias("n"))


# --- merging ---


class Changes:
    """What a parsed set changes in the store. Applying it twice changes nothing more.

    MS and NMR files insert first-wins and fill missing factors; plain files overwrite:
    the last non-null value wins. Files count in order of their id; strict layouts are
    taken before plain ones. ``new_*`` are rows to append; the others are merged states
    with an ``_action`` column, for rewriting the buckets they touch.

    All of them have the columns of ``schemas``; rows that are new get ``created_at``. Stored
    columns that parsing does not give (device, exposure, matrix) are kept.
    """

    def __init__(self, parsed: Parsed, store: dict[str, DataFrame], created_at=None):
        self.parsed = parsed
        names = ("studies", "analyses", "samples", "features", "measurements")
        self.store = {name: schemas.conform(store[name], schemas.SHAPES[name]) for name in names}
        self._study_pk = row_id(F.col("study_id"))
        self._now = F.lit(created_at or datetime.now(timezone.utc)).cast("timestamp")

    def _merged(self, table: str, batch: DataFrame, key: list[str], rules: dict[str, str]) -> DataFrame:
        """``merge`` of a whole table: columns without a rule keep what is stored."""
        shape = schemas.SHAPES[table]
        given = schemas.conform(batch.withColumn("created_at", self._now), shape)
        others = [f.name for f in shape if f.name not in rules and f.name not in key]
        return merge.merge(self.store[table], given, key, rules | dict.fromkeys(others, "keep"))

    @cached_property
    def _good(self) -> DataFrame:
        found = self.parsed.metadata.where(F.col("error").isNull())
        return found.withColumn("study_pk", self._study_pk)

    @cached_property
    def new_studies(self) -> DataFrame:
        studies = self._good.select("study_pk", "study_id", self._now.alias("created_at"))
        new = studies.distinct().join(self.store["studies"].select("study_id"), "study_id", "left_anti")
        return schemas.conform(new, schemas.STUDIES)

    @cached_property
    def analyses(self) -> DataFrame:
        key = ["study_pk", "analysis_id"]
        once = merge.reduce_batch(
            self._good.withColumn("ord", F.col("file_id")),
            key,
            {"file_id": "first_non_null"},
            ["ord"],
        )
        once = once.withColumn("analysis_pk", row_id(F.col("study_pk"), F.col("analysis_id")))
        return self._merged("analyses", once, key, {"file_id": "fill_null"})

    @cached_property
    def samples(self) -> DataFrame:
        key = ["sample_uid"]

        def once(chosen: DataFrame, label: str, factors: str) -> DataFrame:
            picks = {"study_pk": "first", "sample_label": label, "factors_raw": factors}
            rows = chosen.withColumn("study_pk", self._study_pk)
            return merge.reduce_batch(rows, key, picks, ["file_id"])

        strict, plain = self.parsed.strict("samples"), self.parsed.plain("samples")
        filled = self._merged(
            "samples", once(strict, "first", "first_filled"), key, {"factors_raw": "fill_empty"}
        )
        shape = schemas.SAMPLES
        given = schemas.conform(
            once(plain, "last", "last_filled").withColumn("created_at", self._now),
            shape,
            F.lit(None).cast("string").alias("_before"),
        )
        keep = [f.name for f in shape if f.name not in ("sample_uid", "sample_label", "factors_raw")]
        replaced = merge.merge(
            filled.withColumnRenamed("_action", "_before"),
            given,
            key,
            {"sample_label": "latest", "factors_raw": "replace_filled"}
            | dict.fromkeys([*keep, "_before"], "keep"),
        )
        # the strongest of both steps: insert, update, skip, keep
        action = F.lit(merge.KEEP)
        for a in (merge.SKIP, merge.UPDATE, merge.INSERT):
            either = (F.col("_action") == a) | (F.col("_before") == a)
            action = F.when(either, F.lit(a)).otherwise(action)
        return replaced.withColumn("_action", action).drop("_before")

    @cached_property
    def new_features(self) -> DataFrame:
        rows = self.parsed.features.drop("layout")
        new = merge.new_rows(self.store["features"], rows, ["feature_uid"], [F.col("file_id")])
        return schemas.conform(new.withColumn("created_at", self._now), schemas.FEATURES)

    @cached_property
    def filled_features(self) -> DataFrame:
        """State of the stored features whose empty name a plain file fills."""
        rows = self.parsed.plain("features").drop("layout")
        once = merge.reduce_batch(rows, ["feature_uid"], {"name_raw": "first_filled"}, ["file_id"])
        found = once.where(F.coalesce("name_raw", F.lit("")) != "")
        empty = self.store["features"].where(F.coalesce("name_raw", F.lit("")) == "")
        known = found.join(empty.select("feature_uid"), "feature_uid", "left_semi")
        state = self._merged("features", known, ["feature_uid"], {"name_raw": "fill_empty"})
        return state.where(F.col("_action") == merge.UPDATE)

    @cached_property
    def new_measurements(self) -> DataFrame:
        """Rows of MS and NMR files to append."""
        order = [F.col(c) for c in ("file_id", "line_no", "col_index")]
        cells = self.parsed.strict("measurements").where("known")
        new = merge.insert_first(self.store["measurements"], cells, order)
        return schemas.conform(new.withColumn("created_at", self._now), schemas.MEASUREMENTS)

    @cached_property
    def updated_measurements(self) -> DataFrame:
        """State of the measurements after plain files, on top of the appended rows."""
        return self.measurements_on(self.store["measurements"].unionByName(self.new_measurements))

    def measurements_on(self, base: DataFrame) -> DataFrame:
        """State of ``base`` after plain files; it must hold all rows of their samples."""
        cells = self.parsed.plain("measurements").where("known")
        keep = ["file_id", "col_index", "replicate_ix", "created_at"]
        state = merge.coalesce_upsert(base, cells, ["file_id", "line_no", "col_index"], keep)
        return state.withColumn("created_at", F.coalesce("created_at", F.when(F.col("_action") == merge.INSERT, self._now)))

    @cached_property
    def stats(self) -> DataFrame:
        """One row: samples and features created, measurements inserted."""
        inserted = F.col("_action") == merge.INSERT
        parts = [
            (self.samples.where(inserted), "samples_created"),
            (self.new_features, "features_created"),
            (self.new_measurements, "measurements_inserted"),
            (self.updated_measurements.where(inserted), "measurements_inserted"),
        ]
        counted = reduce(
            DataFrame.unionByName,
            [
                df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
                for df, name in parts
            ],
        )
        names = ("samples_created", "features_created", "measurements_inserted")
        return counted.agg(
            *[F.sum(F.when(F.col("what") == name, F.col("n"))).alias(name) for name in names]
        )


# --- jobs ---


@dataclass
class ParseReport:
    """Counts of a parse job, the outcome per file, and what the store gains."""

    files_total: int = 0
    files_success: int = 0
    files_failed: int = 0
    files_skipped: int = 0
    samples_created: int = 0
    features_created: int = 0
    measurements_inserted: int = 0
    warnings_count: int = 0
    by_type: dict[str, int] = field(default_factory=dict)
    outcomes: DataFrame | None = None
    changes: Changes | None = None
    warnings: DataFrame | None = None


def with_ids(texts: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Texts and the stored rows of the files chosen. Spark may take texts for small, so it is told to
    broadcast the files, or where they are many to move both sides."""
    few = chosen.count() <= BROADCAST_FILES
    return texts.join(F.broadcast(chosen) if few else chosen.hint("shuffle_hash"), key)


def with_layout(files: DataFrame, content: Column, found: Column | None = None) -> DataFrame:
    """``files`` and the layout to parse them by: what the markers of plain files show, else the
    detected type."""
    shown = mwtab.layout_by_markers(content) if found is None else found
    plain = F.col("detected_type") == mwtab.PLAIN.name
    layout = F.when(plain, F.coalesce(shown, F.col("detected_type")))
    return files.withColumn("layout", layout.otherwise(F.col("detected_type")))


def parse_directory(
    spark: SparkSession,
    root: str,
    store: dict[str, DataFrame],
    *,
    only_types: Iterable[str] | None = None,
    skip_types: Iterable[str] | None = None,
    max_files: int | None = None,
    fail_fast: bool = False,
    dry_run: bool = False,
    large_bytes: int = LARGE_BYTES,
) -> ParseReport:
    """Parse the files below a directory that have a parsable type (in path order).

    Files over ``large_bytes`` are read as lines, all others as one row each.
    """
    texts = read_texts(spark, root, up_to_bytes=large_bytes)
    typed = texts.withColumn(
        "detected_type", detected_type(filename_of(F.col("file_id")), F.col("content"))
    )
    has_large = not list_files(spark, root).where(F.col("size_bytes") > large_bytes).isEmpty()
    # one scan of the texts gives the types and, by layout, the texts that are wanted
    asked = F.col("detected_type").isin(*PARSABLE) & _asked_for(only_types, skip_types)
    laid_out = with_layout(typed, F.col("content"))
    texts = routed(laid_out.withColumn("layout", F.when(asked, F.col("layout"))))
    types = texts.select("file_id", "detected_type")
    if has_large:
        lines = read_lines(spark, root, over_bytes=large_bytes)
        large_types = settle(types_of_lines(lines), "large-types")
        types = types.unionByName(large_types.select("file_id", "detected_type"))
    types = settle(types, "types")
    marked = parsable_files(types, only_types, skip_types)
    chosen = marked.where("selected").drop("selected")
    # the choice depends on the type alone, so contents need no join and never move
    files = texts.where("layout IS NOT NULL")
    if max_files:
        chosen = chosen.orderBy("file_id").limit(max_files)
        files = files.join(chosen.select("file_id"), "file_id", "left_semi")
    report = ParseReport(files_skipped=marked.where(~F.col("selected")).count())
    parsed = Parsed(files, "layout")
    if has_large:
        # every line learns the layout of its file
        large = large_types.join(chosen.select("file_id"), "file_id", "left_semi")
        large = with_layout(large, F.lit(None), F.col("layout")).drop("detected_type")
        if large.count() <= BROADCAST_FILES:  # else the lines meet the list in a shuffle
            large = F.broadcast(large)
        typed_lines = lines.join(large, "file_id")
        parsed = Parsed(files, "layout", lines=typed_lines, weights=line_weights(spark, root))
    return _parse(spark, chosen, parsed, store, report, fail_fast, dry_run)


def parse_import(
    spark: SparkSession,
    registry: DataFrame,
    texts: DataFrame,
    import_id: str,
    store: dict[str, DataFrame],
    *,
    only_types: Iterable[str] | None = None,
    skip_types: Iterable[str] | None = None,
    max_files: int | None = None,
    fail_fast: bool = False,
    dry_run: bool = False,
) -> ParseReport:
    """Parse the pending and failed files of an import.

    ``texts`` has (file_id, content) under the registry's file ids. ``with_status``
    puts the report's outcomes into the registry.
    """
    pending = pending_files(registry, import_id, only_types, skip_types, max_files)
    chosen = settle(pending.select("file_id", "detected_type"), "pending")
    files = routed(with_layout(with_ids(texts, chosen, "file_id"), F.col("content")))
    return _parse(spark, chosen, Parsed(files, "layout"), store, ParseReport(), fail_fast, dry_run)


def _parse(
    spark: SparkSession,
    chosen: DataFrame,
    parsed: Parsed,
    store: dict[str, DataFrame],
    report: ParseReport,
    fail_fast: bool,
    dry_run: bool,
) -> ParseReport:
    if dry_run:
        types = chosen.groupBy("detected_type").agg(F.count("*").alias("n")).collect()
        report.files_total = sum(r["n"] for r in types)
        report.by_type = {r["detected_type"]: r["n"] for r in types if r["detected_type"] in PARSABLE}
        report.files_skipped += report.files_total - sum(report.by_type.values())
        return report
    parsed = StoredParsed(parsed, shared_folder(spark, "parsed"))
    report.outcomes = outcome(chosen, parsed.metadata)
    if fail_fast:
        stop_on_failure(report.outcomes)
    report.changes = Changes(parsed, store)
    report.warnings = parsed.warnings
    report.warnings_count = parsed.warnings.count()
    totals = outcome_stats(report.outcomes).first().asDict()
    totals["files_skipped"] += report.files_skipped
    # one row per parsable type
    report.by_type = {r["detected_type"]: r["n"] for r in parsed_by_type(report.outcomes).collect()}
    for name, value in (totals | report.changes.stats.first().asDict()).items():
        setattr(report, name, value)
    return report
