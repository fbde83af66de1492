"""mwTab parsing for files too large for one row: the input is a table of lines.

``lines`` has ``file_id``, ``no`` (orders the lines of a file) and ``text``. One file may
hold a large part of all lines. Its structure (ids, blocks, headers) comes from the few
lines that carry structure; data lines then look up their header with a salted join, so
no task and no row ever holds the lines of a whole file.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.functions import keys
from assayframe.functions.text import is_blank, parse_number
from assayframe.operators import mwtab
from assayframe.operators.mwtab import Layout
from assayframe.operators.skew import salted_lookup
from assayframe.sources.tables import settle


class LineMatrices:
    """As ``mwtab.Matrices``, from lines. Steps are built when first used.

    ``counts`` (file_id, n) tells which files are large; without it the lines are
    counted. Keyword arguments go to ``salted_lookup``.
    """

    def __init__(
        self,
        lines: DataFrame,
        layout: Layout,
        counts: DataFrame | None = None,
        need_ids: bool = False,
        **skew: int,
    ):
        self.lines = lines.select("file_id", "no", "text")
        self.layout, self.need_ids, self._skew = layout, need_ids, skew
        self._counts = counts

    @cached_property
    def counts(self) -> DataFrame:
        if self._counts is not None:
            return self._counts
        return self.lines.groupBy("file_id").agg(F.count("*").alias("n"))

    @cached_property
    def few(self) -> DataFrame:
        """The lines that carry structure, stored: they are used often, the scan runs once."""
        layout, text = self.layout, F.col("text")
        marks = mwtab.starts(
            text,
            "#",
            mwtab.STUDY,
            mwtab.ANALYSIS,
            mwtab.FACTOR_LINE,
            layout.units,
            layout.start,
            layout.end,
        )
        wanted = marks | mwtab.is_header(text, layout) if layout.strict else marks
        return settle(self.lines.where(wanted), "structure-lines")

    @cached_property
    def spans(self) -> DataFrame:
        """(file_id, after, before): line numbers around each data block."""
        layout, text, no = self.layout, F.col("text"), F.col("no")
        opens = mwtab.starts(text, layout.start)
        if layout.strict:
            first = self.few.groupBy("file_id").agg(
                F.min(F.when(opens, no)).alias("after"),
                F.min(F.when(mwtab.starts(text, layout.end), no)).alias("before"),
            )
            return first.where(F.col("after").isNotNull())
        bounds = self.few.where(mwtab.is_break(text, layout.start, layout.end))
        following = F.lead("no").over(Window.partitionBy("file_id").orderBy("no"))
        return (
            bounds.select("file_id", opens.alias("opens"), no.alias("after"), following.alias("before"))
            .where("opens")
            .drop("opens")
        )

    @cached_property
    def meta(self) -> DataFrame:
        """Structure lines that count as metadata: for strict layouts those before the data."""
        if not self.layout.strict:
            return self.few
        limited = self.few.join(self.spans, "file_id", "left")
        before = F.col("after").isNull() | (F.col("no") < F.col("after"))
        return limited.where(before).drop("after", "before")

    @cached_property
    def ids(self) -> DataFrame:
        """Per file: ids and unit."""
        layout, text, no = self.layout, F.col("text"), F.col("no")

        def at(value: Column, test: Column) -> Column:
            return F.when(test & value.isNotNull(), no)

        def identifier(marker: str) -> Column:
            inline, own = mwtab.id_in_head(text, marker), mwtab.id_on_own_line(text)
            return F.coalesce(
                F.max_by(inline, at(inline, mwtab.starts(text, mwtab.HEAD))),
                F.min_by(own, at(own, mwtab.starts(text, marker))),
            )

        unit = mwtab.units_text(text, layout)
        return self.meta.groupBy("file_id").agg(
            identifier(mwtab.STUDY).alias("study_id"),
            identifier(mwtab.ANALYSIS).alias("analysis_id"),
            F.max_by(unit, at(unit, mwtab.starts(text, layout.units))).alias("unit"),
        )

    @cached_property
    def metadata(self) -> DataFrame:
        return mwtab.with_reject_reason(self.ids)

    @cached_property
    def factor_lines(self) -> DataFrame:
        """Rows (file_id, f) of the lines in factor sections."""
        text = F.col("text")
        breaks = F.when(mwtab.is_break(text, self.layout.start), text)
        sofar = Window.partitionBy("file_id").orderBy("no")
        opened = self.meta.withColumn("opened", F.last(breaks, ignorenulls=True).over(sofar))
        inside = mwtab.starts(text, mwtab.FACTOR_LINE) & mwtab.starts(
            F.col("opened"), mwtab.FACTOR_SECTION
        )
        line = F.struct("no", "text")
        return opened.where(inside).select("file_id", mwtab.factor_line(line).alias("f"))

    def _lookup(self, dim: DataFrame) -> DataFrame:
        return salted_lookup(
            self.lines,
            dim,
            ["file_id"],
            counts=self.counts,
            n="n",
            spread_by=["no"],
            how="inner",
            **self._skew,
        )

    def _data(self, joined: DataFrame, after: str) -> DataFrame:
        """The data lines behind ``after`` in their block."""
        layout, text = self.layout, F.col("text")
        skipped = (layout.start,) if layout.strict else (mwtab.HEAD, layout.units)
        return joined.where(
            mwtab.between(F.col("no"), F.col(after), F.col("before"))
            & ~mwtab.starts(text, *skipped)
            & ~is_blank(text)
        )

    @cached_property
    def headers(self) -> DataFrame:
        """The header line of each block: (file_id, after, before, header_no, header)."""
        if self.layout.strict:
            named = self.few.where(mwtab.is_header(F.col("text"), self.layout))
            found = self._data(named.join(self.spans, "file_id"), "after")
        else:  # any first line is the header; it is found by an aggregate over data lines
            found = self._data(self._lookup(self.spans), "after")
        first = found.groupBy("file_id", "after", "before").agg(
            F.min("no").alias("header_no"), F.min_by("text", "no").alias("header")
        )
        return first if self.layout.strict else settle(first, "headers")

    @cached_property
    def blocks(self) -> DataFrame:
        """Headers with ids and parsed columns; strict layouts have one block per file."""
        ids = self.ids
        if self.need_ids:
            ids = ids.where("study_id IS NOT NULL AND analysis_id IS NOT NULL")
        none = F.lit(None).cast("array<string>")
        known = self.headers.withColumns({"last_block": F.lit(True), "known_labels": none})
        if not self.layout.strict:
            several = (
                self.headers.groupBy("file_id")
                .agg(
                    F.count("*").alias("n"),
                    F.max("after").alias("last_after"),
                    F.max_by("header", "after").alias("last_header"),
                )
                .where("n > 1")
            )
            # samples that exist where a later block replaces a header
            named = self.factor_lines.join(several, "file_id", "left_semi")
            labels = named.groupBy("file_id").agg(F.collect_set("f.sample_label").alias("named"))
            replaced = several.join(labels, "file_id", "left").select(
                "file_id",
                "last_after",
                F.array_union(
                    F.split("last_header", "\t"), F.coalesce("named", F.array().cast("array<string>"))
                ).alias("kept"),
            )
            joined = self.headers.join(replaced, "file_id", "left")
            is_last = F.col("last_after").isNull() | (F.col("after") == F.col("last_after"))
            known = joined.withColumns(
                {"last_block": is_last, "known_labels": F.when(~is_last, F.col("kept"))}
            ).drop("last_after", "kept")
        study, analysis = (keys.known_or_unknown(F.col(c)) for c in ("study_id", "analysis_id"))
        found = known.join(ids, "file_id").withColumns({"study": study, "analysis": analysis})
        parsed = mwtab.parsed_header(
            F.col("header"), F.col("study"), F.col("analysis"), F.col("known_labels"), self.layout
        )
        return found.select(
            "file_id",
            "study_id",
            "analysis_id",
            "study",
            "analysis",
            "unit",
            "last_block",
            "header_no",
            "before",
            F.explode(F.array(parsed)).alias("h"),
        ).select("*", "h.*").drop("h")

    @cached_property
    def rows(self) -> DataFrame:
        dim = self.blocks.drop("study_id", "analysis_id", "last_block")
        return self._data(self._lookup(dim), "header_no")

    @cached_property
    def named(self) -> DataFrame:
        return mwtab.named_rows(self.rows, self.layout)

    @cached_property
    def cells(self) -> DataFrame:
        return mwtab.cells_of(self.named, self.layout)

    @cached_property
    def marked(self) -> DataFrame:
        return mwtab.marked_cells(self.cells)

    @cached_property
    def line_warnings(self) -> DataFrame:
        usable = self.ids
        if self.need_ids:
            usable = usable.where("study_id IS NOT NULL AND analysis_id IS NOT NULL")
        factors = self.factor_lines.join(usable.select("file_id"), "file_id", "left_semi")
        return mwtab.warnings_of_lines(factors, self.rows)

    @cached_property
    def warnings(self) -> DataFrame:
        found = mwtab.warnings_of_cells(self.marked)
        return found if self.layout.strict else found.unionByName(self.line_warnings)

    @cached_property
    def measurements(self) -> DataFrame:
        cells = self.cells
        return cells.withColumn("value", parse_number(F.col("raw_value"))).drop("raw_value")

    @cached_property
    def features(self) -> DataFrame:
        return mwtab.features_of(self.named, self.layout)

    @cached_property
    def samples(self) -> DataFrame:
        struct = self.ids
        if self.need_ids:
            struct = struct.where("study_id IS NOT NULL AND analysis_id IS NOT NULL")
        factors = self.factor_lines.join(struct, "file_id")
        return mwtab.join_labels(
            mwtab.header_labels(self.blocks, self.layout).unionByName(mwtab.factor_labels(factors)),
            self.layout,
        )
