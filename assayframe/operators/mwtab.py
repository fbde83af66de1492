"""mwTab text to long tables: one row per file in, one row per cell out.

A file travels as one row (its whole text), so finding sections, header and ids
needs no shuffle. Lines and cells are then exploded in a pipeline; the cells of a
row are paired with the header inside the row, so no wide array is copied per cell.
For single files too large for one row see ``mwtab_lines``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions import keys
from assayframe.functions.rules import contains_any
from assayframe.functions.text import (
    after_first,
    factors_without_colon,
    is_blank,
    is_missing_cell,
    is_unreadable_number,
    let,
    once,
    parse_number,
    split_lines,
    strip,
    unix_newlines,
)
from assayframe.schemas import FEATURE_METABOLITE, FEATURE_NMR_BIN
from assayframe.sources.tables import settle

# --- Fixed values: markers and column names of the format. ---

HEAD = "#METABOLOMICS WORKBENCH"
STUDY = "STUDY_ID:"
ANALYSIS = "ANALYSIS_ID:"
FACTOR_SECTION = "#SUBJECT_SAMPLE_FACTORS"
FACTOR_LINE = "SUBJECT_SAMPLE_FACTORS"
FACTORS_ROW = "factors"

NAME_COLUMNS = ("metabolite_name", "metabolite", "compound_name", "compound", "name")
REFMET_COLUMNS = ("refmet_name", "refmet")
NO_REFMET = ("", "-", "NA", "N/A")
MS_SKIP = (
    "samples",
    "factors",
    "metabolite_name",
    "metabolite",
    "compound_name",
    "compound",
    "name",
    "refmet_name",
    "refmet",
    "pubchem_id",
    "kegg_id",
    "hmdb_id",
    "inchi_key",
    "retention_time",
    "retention_index",
    "m/z",
    "mz",
    "mass",
)
NMR_SKIP = (
    "samples",
    "factors",
    "bin range(ppm)",
    "bin_range",
    "bin",
    "ppm_range",
    "ppm",
    "chemical_shift",
    "chemical shift",
    "bucket",
    "bucket_id",
)
NMR_HEADER_WORDS = (
    "samples",
    "bin range",
    "bin_range",
    "ppm",
    "bucket",
    "chemical_shift",
    "chemical shift",
)
NMR_BIN_WORDS = ("bin", "ppm")
MISSING_STUDY = "Missing required metadata: study_id"
MISSING_ANALYSIS = "Missing required metadata: analysis_id"


@dataclass(frozen=True)
class Layout:
    """One way a matrix is laid out in a file."""

    name: str
    section: str
    feature_type: str
    strict: bool  # one block, explicit header row, replicate columns kept

    @property
    def start(self) -> str:
        return f"{self.section}_START"

    @property
    def end(self) -> str:
        return f"{self.section}_END"

    @property
    def units(self) -> str:
        return f"{self.section}:UNITS"


PLAIN = Layout("mwtab", "MS_METABOLITE_DATA", FEATURE_METABOLITE, strict=False)
MS = Layout("mwtab_ms", "MS_METABOLITE_DATA", FEATURE_METABOLITE, strict=True)
NMR = Layout("mwtab_nmr_binned", "NMR_BINNED_DATA", FEATURE_NMR_BIN, strict=True)
LAYOUTS = {layout.name: layout for layout in (PLAIN, MS, NMR)}

# --- end of fixed values ---


def starts(line: Column, *prefixes: str) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.startswith(line, F.lit(prefix))
    return hit


def first_of(array: Column) -> Column:
    return F.get(array, F.lit(0))


def last_of(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def id_in_head(line: Column, marker: str) -> Column:
    return F.nullif(F.regexp_extract(line, f"(?U){marker}(\\S+)", 1), F.lit(""))


def id_on_own_line(line: Column) -> Column:
    return F.nullif(strip(after_first(line, ":")), F.lit(""))


def units_text(line: Column, layout: Layout) -> Column:
    behind_colon = F.substring_index(line, ":", -1) if layout.strict else after_first(line, ":")
    tabbed = F.contains(line, F.lit("\t"))
    text = strip(F.when(tabbed, F.substring_index(line, "\t", -1)).otherwise(behind_colon))
    return text if layout.strict else F.nullif(text, F.lit(""))


def first_cell(line: Column) -> Column:
    return F.lower(strip(F.substring_index(line, "\t", 1)))


def skip_list(layout: Layout) -> tuple[str, ...]:
    return NMR_SKIP if layout is NMR else MS_SKIP


def is_header(line: Column, layout: Layout) -> Column:
    """A header row names itself in its first cell and has at least one sample column."""
    cell = first_cell(line)
    named = contains_any(cell, NMR_HEADER_WORDS) if layout is NMR else cell == "samples"
    has_sample = F.exists(
        F.split(line, "\t"), lambda c: ~F.lower(strip(c)).isin(*skip_list(layout))
    )
    return named & has_sample


def header_indexes(cells: Column, layout: Layout) -> tuple[Column, Column]:
    """(index of the feature name column, index of the refmet column or NULL)"""
    named = F.transform(cells, lambda c, i: F.struct(F.lower(strip(c)).alias("n"), i.alias("i")))

    def where(test) -> Column:
        return F.transform(F.filter(named, test), lambda x: x["i"])

    none = F.lit(None).cast("int")
    if layout is NMR:
        bins = where(
            lambda x: x["n"].isin(*NMR_SKIP)
            & ((x["i"] == 0) | contains_any(x["n"], NMR_BIN_WORDS))
        )
        return F.coalesce(last_of(bins), F.lit(0)), none
    names = where(lambda x: x["n"].isin(*NAME_COLUMNS))
    if layout is MS:
        refmet = where(lambda x: x["n"].isin(*REFMET_COLUMNS))
        return F.coalesce(last_of(names), F.lit(0)), last_of(refmet)
    return F.coalesce(first_of(names), F.lit(0)), none


def places_of(labels: Column) -> Column:
    """For every label: ``nth``, which of its equals it is from the left, and whether it is the last.

    Labels are sorted with their positions, so that equals make a run, and put back by position.
    """
    placed = F.transform(labels, lambda x, i: F.struct(x.alias("label"), i.alias("at")))

    def begins(s: Column) -> Column:
        def new(j: Column) -> Column:
            return (j == 0) | ~F.get(s, j - 1)["label"].eqNullSafe(F.get(s, j)["label"])

        return F.filter(F.sequence(F.lit(0), F.size(s) - 1), new)

    def ranked(s: Column, heads: Column) -> Column:
        def run(head: Column, r: Column) -> Column:
            size = F.coalesce(F.get(heads, r + 1), F.size(s)) - head
            return let(
                size,
                lambda n: F.transform(
                    F.slice(s, head + 1, n),
                    lambda x, j: F.struct(x["at"].alias("at"), (j + 1).alias("nth"), (j + 1 == n).alias("last")),
                ),
            )

        return F.sort_array(F.flatten(F.transform(heads, run)))

    return let(F.sort_array(placed), lambda s: let(begins(s), lambda heads: ranked(s, heads)))


def sample_columns(
    cells: Column,
    name_ix: Column,
    study: Column,
    analysis: Column,
    layout: Layout,
    known_labels: Column | None = None,
) -> Column:
    """Header cells to array<struct<col_index, sample_label, replicate_ix, sample_uid, known>>.

    Strict layouts trim labels, drop known other columns and number repeated labels
    from left to right. The plain layout keeps labels as they are, and of a repeated
    label only the last column counts. Both sort the labels where the header has any
    repeat (``places_of``). ``known`` tells whether the column's sample exists: strict layouts
    take no sample from the first column, the plain layout none from a header that a
    later block replaced (then ``known_labels`` holds what exists).
    """

    def uid(label: Column) -> Column:
        if layout is NMR:
            return keys.nmr_sample_uid(study, analysis, label)
        return keys.sample_uid(study, label)

    def column(label: Column, i: Column, replicate: Column, known: Column) -> Column:
        return F.struct(
            i.alias("col_index"),
            label.alias("sample_label"),
            replicate.cast("int").alias("replicate_ix"),
            uid(label).alias("sample_uid"),
            known.alias("known"),
        )

    def strict_columns(h: Column) -> Column:
        labels = h["labels"]

        def nth(i: Column) -> Column:
            return F.when(h["unique"], F.lit(1)).otherwise(F.get(h["places"], i)["nth"])

        def known(label: Column, i: Column) -> Column:
            others = F.slice(labels, F.lit(2), F.size(labels))
            return (i > 0) | F.array_contains(others, label)

        columns = F.transform(labels, lambda x, i: column(x, i, nth(i), known(x, i)))
        return F.filter(columns, lambda c: ~F.lower(c["sample_label"]).isin(*skip_list(layout)))

    def plain_columns(h: Column) -> Column:
        labels, name = h["labels"], h["name_ix"]

        def known(label: Column) -> Column:
            if known_labels is None:
                return F.lit(True)
            return known_labels.isNull() | F.array_contains(known_labels, label)

        def last(i: Column) -> Column:
            return h["unique"] | F.get(h["places"], i)["last"]

        columns = F.transform(
            labels,
            lambda x, i: F.when((i != name) & last(i), column(x, i, F.lit(None), known(x))),
        )
        return F.array_compact(columns)

    labels = F.transform(cells, strip) if layout.strict else cells

    def with_places(ls: Column) -> Column:
        # the plain layout's name column is no sample, whatever another column is called
        counted = ls if layout.strict else F.transform(ls, lambda x, i: F.when(i != name_ix, x))
        unique = F.size(F.array_distinct(ls)) == F.size(ls)
        return F.struct(
            ls.alias("labels"),
            unique.alias("unique"),
            F.when(~unique, places_of(counted)).alias("places"),
            name_ix.alias("name_ix"),
        )

    head = let(labels, with_places)
    return let(head, strict_columns if layout.strict else plain_columns)


def feature_key(analysis: Column, name: Column, refmet: Column, layout: Layout) -> Column:
    if layout is NMR:
        return keys.nmr_feature_uid(analysis, name)
    if layout is MS:
        return keys.ms_feature_uid(analysis, name, refmet)
    return keys.feature_uid(analysis, name)


def refmet_text(cells: Column, refmet_ix: Column) -> Column:
    text = strip(F.get(cells, refmet_ix))
    return F.when(~text.isin(*NO_REFMET), text)


def between(no: Column, after: Column, before: Column) -> Column:
    return (no > after) & (before.isNull() | (no < before))


def is_break(text: Column, *more: str) -> Column:
    """A line that ends the running section."""
    return (starts(text, "#") & ~starts(text, HEAD)) | starts(text, *more)


def _file_facts(m: Column, layout: Layout) -> Column:
    """struct of what the structure lines tell: ids, unit, factor lines, spans of data.

    ``m`` holds ``marks`` (structure lines in order) and the first ``start_no`` and
    ``end_no``. Strict layouts read metadata only before the data starts and have one
    span; the plain layout has a span per block.
    """
    marks = m["marks"]
    before_data = m["start_no"].isNull()
    meta = (
        F.filter(marks, lambda x: before_data | (x["no"] < m["start_no"]))
        if layout.strict
        else marks
    )

    def facts(meta: Column) -> Column:
        def texts(*prefixes: str) -> Column:
            hits = F.filter(meta, lambda x: starts(x["text"], *prefixes))
            return F.transform(hits, lambda x: x["text"])

        def identifier(marker: str) -> Column:
            inline = F.transform(texts(HEAD), lambda t: id_in_head(t, marker))
            own_line = F.transform(texts(marker), id_on_own_line)
            return F.coalesce(
                last_of(F.array_compact(inline)), first_of(F.array_compact(own_line))
            )

        def factor_lines(breaks: Column) -> Column:
            def opened(x: Column) -> Column:
                last = last_of(F.filter(breaks, lambda b: b["no"] < x["no"]))
                return starts(last["text"], FACTOR_SECTION)

            found = F.filter(meta, lambda x: starts(x["text"], FACTOR_LINE) & opened(x))
            return F.transform(found, factor_line)

        units = F.transform(texts(layout.units), lambda t: units_text(t, layout))
        breaks = F.filter(meta, lambda x: is_break(x["text"], layout.start))
        return F.struct(
            identifier(STUDY).alias("study_id"),
            identifier(ANALYSIS).alias("analysis_id"),
            last_of(units if layout.strict else F.array_compact(units)).alias("unit"),
            let(breaks, factor_lines).alias("factor_lines"),
            _spans(m, layout).alias("spans"),
        )

    return let(meta, facts)


def factor_line(x: Column) -> Column:
    parts = F.split(x["text"], "\t")
    return F.struct(
        x["no"].alias("no"),
        x["text"].alias("text"),
        F.size(parts).alias("fields"),
        strip(F.get(parts, F.lit(1))).alias("subject"),
        strip(F.get(parts, F.lit(2))).alias("sample_label"),
        strip(F.get(parts, F.lit(3))).alias("factors_raw"),
    )


def _spans(m: Column, layout: Layout) -> Column:
    """array<struct<after, before>>: line numbers around each data block."""
    if layout.strict:
        one = F.struct(m["start_no"].alias("after"), m["end_no"].alias("before"))
        return F.when(m["start_no"].isNotNull(), F.array(one))

    def spans(bounds: Column) -> Column:
        every = F.transform(
            bounds,
            lambda x, i: F.when(
                starts(x["text"], layout.start),
                F.struct(x["no"].alias("after"), F.get(bounds, i + 1)["no"].alias("before")),
            ),
        )
        return F.array_compact(every)

    return let(F.filter(m["marks"], lambda x: is_break(x["text"], layout.start, layout.end)), spans)


def structure(files: DataFrame, layout: Layout) -> DataFrame:
    """Per file: ids, unit, factor lines and spans of data, found without a shuffle.

    ``files`` has ``file_id`` and ``content``. All of it is one expression per row. The
    lines are scanned once for the few that carry structure; the rest looks at those.
    """
    numbered = F.transform(
        split_lines(F.col("content")), lambda t, i: F.struct((i + 1).alias("no"), t.alias("text"))
    )
    marks = F.filter(
        numbered,
        lambda x: starts(
            x["text"], "#", STUDY, ANALYSIS, FACTOR_LINE, layout.units, layout.start, layout.end
        ),
    )

    def bounded(ms: Column) -> Column:
        def number(prefix: str) -> Column:
            return first_of(F.filter(ms, lambda x: starts(x["text"], prefix)))["no"]

        return F.struct(
            ms.alias("marks"),
            number(layout.start).alias("start_no"),
            number(layout.end).alias("end_no"),
        )

    facts = let(let(marks, bounded), lambda m: _file_facts(m, layout))
    texts = once(files.select("file_id", "content"), "content")
    found = once(texts.withColumn("facts", facts), "facts")
    return found.select("file_id", "content", "facts.*")


def parsed_header(
    header: Column, study: Column, analysis: Column, known_labels: Column, layout: Layout
) -> Column:
    """struct<name_ix, refmet_ix, columns> of a header line."""

    def with_cells(cells: Column) -> Column:
        name_ix, refmet_ix = header_indexes(cells, layout)

        def with_name(ix: Column) -> Column:
            return F.struct(
                ix["name"].alias("name_ix"),
                ix["refmet"].alias("refmet_ix"),
                sample_columns(cells, ix["name"], study, analysis, layout, known_labels).alias(
                    "columns"
                ),
            )

        return let(F.struct(name_ix.alias("name"), refmet_ix.alias("refmet")), with_name)

    return let(F.split(header, "\t"), with_cells)


def blocks(struct: DataFrame, layout: Layout, every_file: bool = False) -> DataFrame:
    """Data blocks that have a header, one row each, with their data lines in ``rows``.

    With ``every_file`` blocks without a header and files without a block have a row too, and
    ``block_no`` tells the blocks of a file apart (0 or NULL: the file's first row).
    """

    def inside(span: Column) -> Column:
        numbered = F.transform(
            split_lines(F.col("content")),
            lambda t, i: F.struct((i + 1).alias("no"), t.alias("text")),
        )
        skipped = (layout.start,) if layout.strict else (HEAD, layout.units)
        return F.filter(
            numbered,
            lambda x: between(x["no"], span["after"], span["before"])
            & ~starts(x["text"], *skipped)
            & ~is_blank(x["text"]),
        )

    def replaced_labels(last: Column) -> Column:
        """What samples exist when several blocks do: the last header's and the factor lines'."""
        labels = F.split(first_of(inside(last))["text"], "\t")
        named = F.transform("factor_lines", lambda f: f["sample_label"])
        return F.array_union(labels, F.array_compact(named))

    last_span = last_of(F.col("spans"))
    spans = struct.withColumns(
        {
            "last_start": last_span["after"],
            "known_labels": F.when(F.size("spans") > 1, let(last_span, replaced_labels)),
        }
    ).select("*", F.posexplode_outer("spans").alias("block_no", "span"))

    def split_header(lines: Column) -> Column:
        candidates = F.filter(lines, lambda x: is_header(x["text"], layout))
        header = first_of(candidates if layout.strict else lines)
        return let(
            header,
            lambda h: F.struct(
                h.alias("header"), F.filter(lines, lambda x: x["no"] > h["no"]).alias("rows")
            ),
        )

    study, analysis = (keys.known_or_unknown(F.col(c)) for c in ("study_id", "analysis_id"))
    # explode (Generate) is a boundary: what is computed below it is computed once
    found = spans.select(
        "file_id",
        "study_id",
        "analysis_id",
        "unit",
        "factor_lines",
        F.when(F.col("span.after") != F.col("last_start"), F.col("known_labels")).alias("known_labels"),
        (F.col("span.after") == F.col("last_start")).alias("last_block"),
        "block_no",
        F.explode(F.array(let(inside(F.col("span")), split_header))).alias("block"),
    )
    if not every_file:
        found = found.where(F.col("block.header").isNotNull())
    extra = ["block_no", F.col("block.header").isNotNull().alias("has_header")]
    return found.select(
        "file_id",
        "study_id",
        "analysis_id",
        study.alias("study"),
        analysis.alias("analysis"),
        "unit",
        "factor_lines",
        "last_block",
        *(extra if every_file else []),
        F.explode(
            F.array(
                parsed_header(
                    F.col("block.header.text"), study, analysis, F.col("known_labels"), layout
                )
            )
        ).alias("h"),
        F.col("block.rows").alias("rows"),
    ).select("*", "h.*").drop("h")


def data_rows(found: DataFrame) -> DataFrame:
    """The data lines of blocks, one row each."""
    rows = found.withColumn("row", F.explode("rows")).drop("rows")
    return rows.withColumns({"no": F.col("row.no"), "text": F.col("row.text")}).drop("row")


def named_rows(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows (``no``, ``text``) with their cells, feature name and feature key.

    Rows without a name still pass; the callers drop them. The split is behind an explode, a
    boundary, so that no filter on what comes of it makes a row be split again.
    """
    named = once(rows.withColumn("cells", F.split("text", "\t")), "cells")
    if layout.strict:
        named = named.where(F.lower(strip(first_of(F.col("cells")))) != FACTORS_ROW)
    name = strip(F.get("cells", F.col("name_ix")))
    if not layout.strict:
        name = F.when(F.size("cells") >= 2, name)
    named = named.withColumn("feature_name", F.nullif(name, F.lit("")))
    named = named.withColumn("refmet_name", refmet_text(F.col("cells"), F.col("refmet_ix")))
    key = feature_key(F.col("analysis"), F.col("feature_name"), F.col("refmet_name"), layout)
    return named.withColumn("feature_uid", key)


def cells_of(rows: DataFrame, layout: Layout) -> DataFrame:
    """One row per cell of named rows."""
    carried = ["file_id", "study", "analysis", "no", "feature_uid", "feature_name", "refmet_name"]
    named = F.when(F.col("feature_name").isNotNull(), F.col("columns"))
    # the cell is taken behind the explode, in the same pipeline, so ``cells`` is not copied
    return rows.select(*carried, "unit", "cells", F.explode(named).alias("col")).select(
        "file_id",
        F.col("study").alias("study_id"),
        F.col("analysis").alias("analysis_id"),
        F.col("no").alias("line_no"),
        F.col("col.col_index").alias("col_index"),
        F.col("col.sample_label").alias("sample_label"),
        F.col("col.sample_uid").alias("sample_uid"),
        "feature_uid",
        "feature_name",
        "refmet_name",
        F.get("cells", F.col("col.col_index")).alias("raw_value"),
        F.col("col.replicate_ix").alias("replicate_ix"),
        "unit",
        F.col("col.known").alias("known"),
    )


class Matrices:
    """Lazy tables of a set of files with one layout. Steps are built when first used.

    ``files`` has ``file_id`` and ``content``. With ``need_ids`` files without study or
    analysis id give no rows; else their keys say UNKNOWN.
    """

    def __init__(self, files: DataFrame, layout: Layout, need_ids: bool = False):
        self.files, self.layout, self.need_ids = files, layout, need_ids

    @cached_property
    def structure(self) -> DataFrame:
        return structure(self.files, self.layout)

    @cached_property
    def usable(self) -> DataFrame:
        """Structure of the files that give rows."""
        if not self.need_ids:
            return self.structure
        return self.structure.where("study_id IS NOT NULL AND analysis_id IS NOT NULL")

    @cached_property
    def blocks(self) -> DataFrame:
        return blocks(self.usable, self.layout)

    @cached_property
    def every_block(self) -> DataFrame:
        """Blocks, and a row at least for every file that gives rows."""
        return blocks(self.usable, self.layout, every_file=True)

    @cached_property
    def rows(self) -> DataFrame:
        return data_rows(self.blocks)

    @cached_property
    def named(self) -> DataFrame:
        return named_rows(self.rows, self.layout)

    @cached_property
    def cells(self) -> DataFrame:
        return cells_of(self.named, self.layout)

    @cached_property
    def measurements(self) -> DataFrame:
        """All cells with a parsed value, replicates and repeated features included."""
        return self.cells.withColumn("value", parse_number(F.col("raw_value"))).drop("raw_value")

    @cached_property
    def metadata(self) -> DataFrame:
        """Per file: ids, units and the reason it is rejected, if any."""
        return with_reject_reason(self.structure)

    @cached_property
    def rejects(self) -> DataFrame:
        return self.metadata.where(F.col("error").isNotNull()).select("file_id", "error")

    @cached_property
    def samples(self) -> DataFrame:
        return samples_of(self.every_block, self.layout)

    @cached_property
    def features(self) -> DataFrame:
        return features_of(self.named, self.layout)

    @cached_property
    def marked(self) -> DataFrame:
        """Measurements and ``unreadable``: the text of a cell that is no number, else NULL."""
        return marked_cells(self.cells)

    @cached_property
    def line_warnings(self) -> DataFrame:
        return warnings_of_blocks(self.every_block, self.layout, cells=False)

    @cached_property
    def warnings(self) -> DataFrame:
        if self.layout.strict:
            return warnings_of_cells(self.marked)
        return warnings_of_blocks(self.every_block, self.layout)


class StoredMatrices(Matrices):
    """``Matrices`` whose texts were read once: structure and blocks come from one written table."""

    def __init__(self, parsed: Matrices, purpose: str = "blocks"):
        super().__init__(parsed.files, parsed.layout, parsed.need_ids)
        self._table = settle(blocks(parsed.structure, parsed.layout, every_file=True), purpose)

    @cached_property
    def structure(self) -> DataFrame:
        columns = ["file_id", "study_id", "analysis_id", "unit", "factor_lines"]
        return self._table.where(_is_first_block()).select(*columns)

    @cached_property
    def every_block(self) -> DataFrame:
        if not self.need_ids:
            return self._table
        return self._table.where("study_id IS NOT NULL AND analysis_id IS NOT NULL")

    @cached_property
    def blocks(self) -> DataFrame:
        return self.every_block.where("has_header").drop("block_no", "has_header")


def _is_first_block() -> Column:
    """The row of ``blocks(..., every_file=True)`` that speaks for its file."""
    return F.col("block_no").isNull() | (F.col("block_no") == 0)


def with_reject_reason(struct: DataFrame) -> DataFrame:
    reason = F.when(F.col("study_id").isNull(), F.lit(MISSING_STUDY)).when(
        F.col("analysis_id").isNull(), F.lit(MISSING_ANALYSIS)
    )
    return struct.select("file_id", "study_id", "analysis_id", "unit", reason.alias("error"))


def measurements(files: DataFrame, layout: Layout) -> DataFrame:
    return Matrices(files, layout).measurements


def samples_of(every: DataFrame, layout: Layout) -> DataFrame:
    """Samples of each file with the factors of their label.

    ``every``: ``blocks`` with a row for every file. Strict layouts take the samples from the header
    (first column excluded); the plain layout adds the labels of factor lines. Of a label's factor
    lines the last counts. Header cells and factor lines leave a file's row together, so its text is
    scanned once, and meet in one aggregate over labels, not cells.
    """
    none = F.lit(None).cast("string")

    def label(name: Column, subject: Column, factors: Column, in_header: bool, no: Column) -> Column:
        return F.struct(
            name.alias("sample_label"),
            subject.alias("subject"),
            factors.alias("factors_raw"),
            F.lit(in_header).alias("in_header"),
            no.alias("no"),
        )

    lines = F.filter("factor_lines", lambda f: (f["fields"] >= 4) & (f["sample_label"] != ""))
    from_lines = F.transform(
        F.when(_is_first_block(), lines),
        lambda f: label(f["sample_label"], f["subject"], f["factors_raw"], False, f["no"]),
    )
    columns = F.filter("columns", lambda c: (c["col_index"] > 0) | F.lit(not layout.strict))
    from_header = F.transform(
        F.when(F.col("last_block") & F.col("has_header"), columns),
        lambda c: label(c["sample_label"], none, none, True, F.lit(None).cast("int")),
    )
    found = F.explode(_together(from_lines, from_header)).alias("x")
    labels = every.select("file_id", "study_id", "analysis_id", found)
    return join_labels(labels.select("file_id", "study_id", "analysis_id", "x.*"), layout)


def _together(*arrays: Column) -> Column:
    """One array of the elements of arrays; those that are null have none."""
    return F.flatten(F.array_compact(F.array(*arrays)))


def header_labels(found: DataFrame, layout: Layout) -> DataFrame:
    """Label rows of the last block's header."""
    none = F.lit(None)
    columns = found.where("last_block").select(
        "file_id", "study_id", "analysis_id", F.explode("columns").alias("c")
    )
    return columns.where((F.col("c.col_index") > 0) | F.lit(not layout.strict)).select(
        "file_id",
        "study_id",
        "analysis_id",
        F.col("c.sample_label").alias("sample_label"),
        none.cast("string").alias("subject"),
        none.cast("string").alias("factors_raw"),
        F.lit(True).alias("in_header"),
        none.alias("no"),
    )


def factor_labels(factors: DataFrame) -> DataFrame:
    """Label rows of factor lines ``f``."""
    good = factors.where((F.col("f.fields") >= 4) & (F.col("f.sample_label") != ""))
    return good.select(
        "file_id",
        "study_id",
        "analysis_id",
        *[F.col(f"f.{c}").alias(c) for c in ("sample_label", "subject", "factors_raw")],
        F.lit(False).alias("in_header"),
        F.col("f.no").alias("no"),
    )


def join_labels(labels: DataFrame, layout: Layout) -> DataFrame:
    """Samples from label rows of headers and of factor lines."""
    study, analysis = (keys.known_or_unknown(F.col(c)) for c in ("study_id", "analysis_id"))
    groups = ["file_id", study.alias("study_id"), analysis.alias("analysis"), "sample_label"]
    from_line = F.when(~F.col("in_header"), F.col("no"))
    merged = labels.groupBy(*groups).agg(
        F.max("in_header").alias("in_header"),
        F.max_by(F.struct("subject", "factors_raw"), from_line).alias("f"),
    )
    uid = (
        keys.nmr_sample_uid(F.col("study_id"), F.col("analysis"), F.col("sample_label"))
        if layout is NMR
        else keys.sample_uid(F.col("study_id"), F.col("sample_label"))
    )
    factors = F.col("f.factors_raw")
    return merged.where(F.col("in_header") | F.lit(not layout.strict)).select(
        "file_id",
        "study_id",
        "sample_label",
        uid.alias("sample_uid"),
        F.coalesce("f.subject", F.lit("")).alias("subject"),
        (F.nullif(factors, F.lit("")) if layout.strict else factors).alias("factors_raw"),
    )


def features_of(named: DataFrame, layout: Layout) -> DataFrame:
    """Distinct features of each file with the first name seen; no cell is exploded."""
    rows = named.where(F.col("feature_name").isNotNull())
    picked = rows.groupBy("file_id", "feature_uid").agg(
        F.min_by(F.struct("feature_name", "refmet_name", "analysis"), F.col("no")).alias("f")
    )
    return picked.select(
        "file_id",
        "feature_uid",
        F.lit(layout.feature_type).alias("feature_type"),
        F.col("f.feature_name").alias("name_raw"),
        F.col("f.refmet_name").alias("refmet_name"),
        (F.col("f.analysis") if layout.strict else F.lit(None).cast("string")).alias("analysis_id"),
    )


def marked_cells(cells: DataFrame) -> DataFrame:
    # a cell is unreadable if it is not missing and no number: only cells without a value are looked at
    raw = F.col("raw_value")
    valued = cells.withColumn("value", parse_number(raw))
    unreadable = F.when(F.col("value").isNull() & ~is_missing_cell(raw), strip(raw))
    return valued.withColumn("unreadable", unreadable).drop("raw_value")


def warnings_of_cells(marked: DataFrame) -> DataFrame:
    """(file_id, line_no, kind, text) of the cells that are no number."""
    return marked.where(F.col("unreadable").isNotNull()).select(
        "file_id",
        "line_no",
        F.lit("unreadable_value").alias("kind"),
        F.col("unreadable").alias("text"),
    )


def warnings_of_lines(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(file_id, line_no, kind, text) of the lines of plain files that were skipped.

    ``lines`` has file_id and the factor lines ``f``."""
    no = F.col("f.no").alias("line_no")
    bad_fields = lines.where(F.col("f.fields") < 4).select(
        "file_id", no, F.lit("factor_line_too_short").alias("kind"), F.col("f.text").alias("text")
    )
    no_label = lines.where((F.col("f.fields") >= 4) & (F.col("f.sample_label") == "")).select(
        "file_id", no, F.lit("empty_sample_label").alias("kind"), F.col("f.text").alias("text")
    )
    labelled = lines.where((F.col("f.fields") >= 4) & (F.col("f.sample_label") != ""))
    no_colon = labelled.select(
        "file_id",
        no,
        F.lit("factor_without_colon").alias("kind"),
        F.explode(factors_without_colon(F.col("f.factors_raw"))).alias("text"),
    )
    cut = rows.where(
        (F.size(F.split("text", "\t")) >= 2) & (F.size(F.split("text", "\t")) <= F.col("name_ix"))
    ).select(
        "file_id",
        F.col("no").alias("line_no"),
        F.lit("name_column_out_of_range").alias("kind"),
        "text",
    )
    return bad_fields.unionByName(no_label).unionByName(no_colon).unionByName(cut)


def warnings_of_blocks(every: DataFrame, layout: Layout, cells: bool = True) -> DataFrame:
    """(file_id, line_no, kind, text) of what plain files hold and parsing leaves out: as
    ``warnings_of_lines`` and, with ``cells``, ``warnings_of_cells``, but the texts are scanned once.

    ``every``: ``blocks`` with a row for every file. Its factor lines and data lines are exploded
    together.
    """
    shape = every.schema["factor_lines"].dataType.elementType
    factors = F.transform(
        F.when(_is_first_block(), F.col("factor_lines")),
        lambda f: F.struct(f["no"].alias("no"), f["text"].alias("text"), f.alias("f")),
    )
    data = F.transform(
        F.when(F.col("has_header"), F.col("rows")),
        lambda r: F.struct(r["no"].alias("no"), r["text"].alias("text"), F.lit(None).cast(shape).alias("f")),
    )
    carried = ["file_id", "analysis", "name_ix", "refmet_ix", "columns"]
    lines = every.select(*carried, F.explode(_together(factors, data)).alias("x"))
    lines = named_rows(lines.select(*carried, "x.*"), layout)

    def told(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    f, size = F.col("f"), F.size("cells")
    loose = F.transform(
        factors_without_colon(f["factors_raw"]), lambda t: told("factor_without_colon", t)
    )
    of_factors = (
        F.when(f["fields"] < 4, F.array(told("factor_line_too_short", f["text"])))
        .when(f["sample_label"] == "", F.array(told("empty_sample_label", f["text"])))
        .when(f["sample_label"] != "", loose)
    )
    cut = F.when(
        (size >= 2) & (size <= F.col("name_ix")),
        F.array(told("name_column_out_of_range", F.col("text"))),
    )
    raw = F.transform("columns", lambda c: told("unreadable_value", F.get("cells", c["col_index"])))
    of_data = _together(cut, F.when(F.col("feature_name").isNotNull(), raw)) if cells else cut
    found = lines.select(
        "file_id",
        F.col("no").alias("line_no"),
        F.explode(F.when(f.isNotNull(), of_factors).otherwise(of_data)).alias("w"),
    ).select("file_id", "line_no", "w.*")
    if not cells:
        return found
    is_cell = F.col("kind") == "unreadable_value"
    kept = found.where(~is_cell | is_unreadable_number(F.col("text")))
    return kept.withColumn("text", F.when(is_cell, strip(F.col("text"))).otherwise(F.col("text")))


def _named_samples(line: Column) -> Column:
    """A header row of the MS layout: it has further cells and its first one is 'samples'."""
    return F.contains(line, F.lit("\t")) & (first_cell(line) == "samples")


def layout_by_markers(content: Column) -> Column:
    """Layout name by section markers and header, for files typed plain ``mwtab``.

    A binned section means NMR; a matrix section that has a header row whose first cell is
    'Samples', before the section ends, means MS; any other matrix section is plain.
    """
    framed = F.concat(F.lit("\n"), unix_newlines(content))
    behind = after_first(framed, "\n" + MS.start)
    section = F.substring_index(behind, "\n" + MS.end, 1)
    # one pass over the section, line by line
    ms = F.exists(F.split(section, "\n"), _named_samples)
    matrix = F.contains(framed, F.lit("\n" + MS.start))
    return (
        F.when(F.contains(framed, F.lit("\n" + NMR.start)), F.lit(NMR.name))
        .when(matrix & ms, F.lit(MS.name))
        .when(matrix, F.lit(PLAIN.name))
    )


def layout_of_lines(no: Column, text: Column) -> Column:
    """``layout_by_markers`` as an aggregate over the lines of a file."""
    start = F.min(F.when(starts(text, MS.start), no))
    end = F.min(F.when(starts(text, MS.end), no))
    names = F.collect_list(F.when(_named_samples(text), no))
    ms = F.exists(names, lambda n: (n > start) & (end.isNull() | (end < start) | (n < end)))
    nmr = F.max(starts(text, NMR.start))
    return (
        F.when(nmr, F.lit(NMR.name))
        .when(start.isNotNull() & ms, F.lit(MS.name))
        .when(start.isNotNull(), F.lit(PLAIN.name))
    )
