"""mwTab files rendered from the given tables, parsed, and compared with their source.

A document becomes one file: the lengths of its words (whole text, split at blanks) are
the cells of a matrix of eight columns. The rendering is done inside the row. For the
line parser lineitem becomes three files, each with a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.operators import mwtab, mwtab_lines
from assayframe.plans import parse
from assayframe.session import shared_folder
from assayframe.sources.tables import settle
from bindings.core import bound, ctes, load, pick, table

COLUMNS = 8
# Word i has length n. Some cells are missing, grouped by thousands, or unreadable.
CELL = """CASE WHEN i % 11 = 0 THEN 'NA' WHEN i % 13 = 5 THEN '1,' || lpad(cast(n % 1000 AS string), 3, '0')
 WHEN i % 17 = 3 THEN 'bad' || n WHEN i % 23 = 7 THEN ' ' || n || 'e-1 ' ELSE cast(n AS string) END"""
VALUE = """CASE WHEN i % 11 = 0 THEN NULL WHEN i % 13 = 5 THEN 1000.0 + n % 1000
 WHEN i % 17 = 3 THEN NULL WHEN i % 23 = 7 THEN n / 10.0 ELSE n END"""
STUDY_OF = "'ST' || doc_id % 40"

HEADS = {
    # name column, then the eight columns
    "mwtab": "Metabolite_name\tS1\tS2\tS3\tS1\tS4\t S5\tS6\tS7",
    "mwtab_ms": "Samples\tS1\tS2\tS3\tS1\tS4\trefmet_name\t S5 \tS6",
    "mwtab_nmr_binned": "Bin range(ppm)\tS1\tS2\tS3\tS1\tS4\tbucket_id\t S5 \tS6",
}


def render(spark, sf_dir, layout: mwtab.Layout, break_ids: bool = False) -> DataFrame:
    """(file_id, content) of one file per document."""
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id",
        F.format_string("F%d", "doc_id").alias("file_id"),
        file_text(layout, break_ids).alias("content"),
    )


def file_text(layout: mwtab.Layout, break_ids: bool = False) -> Column:
    """The text of a document's file; with ``break_ids`` some files lack an id."""
    eol = "\r\n" if layout is mwtab.NMR else "\n"
    cell = CELL.replace("n %", "c.n %").replace("i %", "c.i %")
    cell = cell.replace("|| n", "|| c.n").replace("cast(n ", "cast(c.n ")
    # transform over a one-element array keeps the split words as one value
    lines = f"""transform(array(split(text, ' ')), words ->
      transform(sequence(0, cast(ceil(size(words) / {COLUMNS}) AS int) - 1), r ->
        concat('Feat  ', cast(r % 40 AS string), '\\t', array_join(transform(
          transform(slice(words, r * {COLUMNS} + 1, {COLUMNS}),
                    (x, j) -> named_struct('i', r * {COLUMNS} + j, 'n', length(x))),
          c -> {cell}), '\\t'))))[0]"""
    study = "CASE WHEN doc_id % 10 = 1 THEN '' ELSE ' STUDY_ID:' || " + STUDY_OF + " END"
    if not break_ids:
        study = "' STUDY_ID:' || " + STUDY_OF
    own = "CASE WHEN doc_id % 10 = 1 AND doc_id % 20 = 1 THEN 'STUDY_ID: ST7 ' ELSE 'VERSION\t1' END"
    analysis = "CASE WHEN doc_id % 10 = 2 THEN '' ELSE ' ANALYSIS_ID:AN' || doc_id END"
    if not break_ids:
        own, analysis = "'VERSION\t1'", "' ANALYSIS_ID:AN' || doc_id"
    factors = [
        "'SUBJECT_SAMPLE_FACTORS\t-\tS1\tGroup:first'",
        "'SUBJECT_SAMPLE_FACTORS\t' || lang || '\tS1\tGroup:' || source || ' | loose'",
        "'SUBJECT_SAMPLE_FACTORS\t-\tS9\tGroup:none'",
        "'SUBJECT_SAMPLE_FACTORS\ttoo short'",
    ]
    head = [
        f"'#METABOLOMICS WORKBENCH doc' || {study} || {analysis}",
        own,
        "'#SUBJECT_SAMPLE_FACTORS:\tSUBJECT\tSAMPLE\tFACTORS'",
        *factors,
        "'#DATA'",
        f"'{layout.units}\tunit ' || lang",
        f"'{layout.start}'",
        f"'{HEADS[layout.name]}'",
        "'Factors\ta\tb'",
    ]
    if layout is mwtab.PLAIN:
        head.pop()
    texts = [F.expr(h.replace("\t", "\\t")) for h in head]
    return F.concat_ws(
        eol,
        *texts,
        F.expr(lines),
        F.lit("\tno name\t1"),
        F.lit(layout.end),
        F.lit("trailing\t1\t2"),
    )


FIRST_LINE = {"mwtab": 12, "mwtab_ms": 13, "mwtab_nmr_binned": 13}


def _grid(layout: mwtab.Layout, labels: dict[int, str]) -> str:
    """(doc_id, r, col_index, label, i, n, ...) of every sample cell, missing ones too."""
    cols = ", ".join(f"({c}, '{label}')" for c, label in labels.items())
    return f"""
tok AS (SELECT doc_id, lang, source, string_split(text, ' ') AS a FROM documents),
cols(c, label) AS (VALUES {cols}),
rws AS (SELECT doc_id, lang, a, r FROM tok,
        unnest(range(CAST(ceil(len(a) / {COLUMNS}.0) AS BIGINT))) t(r)),
g AS (SELECT doc_id, lang, r, c, label, r * {COLUMNS} + c - 1 AS i,
        length(a[r * {COLUMNS} + c]) AS n, a[r * {COLUMNS} + 6] IS NOT NULL AS has6,
        r * {COLUMNS} + 5 AS i6, length(a[r * {COLUMNS} + 6]) AS n6, {FIRST_LINE[layout.name]} + r AS line_no
      FROM rws, cols)"""


STRICT = {1: "S1", 2: "S2", 3: "S3", 4: "S1", 5: "S4", 7: "S5", 8: "S6"}
# of the repeated label S1 only the last column counts; labels keep their blanks
PLAIN = {2: "S2", 3: "S3", 4: "S1", 5: "S4", 6: " S5", 7: "S6", 8: "S7"}
V = f"CAST({VALUE} AS DOUBLE)"
REPLICATE = "CASE WHEN c = 4 THEN 2 ELSE 1 END"


@bound(
    "mwtab_ms_long",
    f"""WITH {_grid(mwtab.MS, STRICT)}
    SELECT 'F' || doc_id AS file_id, CAST(line_no AS INTEGER) AS line_no, c AS col_index,
      {STUDY_OF} || ':' || label AS sample_uid,
      'AN' || doc_id || ':met:feat ' || r % 40 AS feature_uid,
      'unit ' || lang AS unit, {REPLICATE} AS replicate_ix, {V} AS value FROM g""",
)
def mwtab_ms_long(spark, sf_dir):
    cells = mwtab.Matrices(render(spark, sf_dir, mwtab.MS), mwtab.MS).measurements
    return cells.select(
        "file_id",
        "line_no",
        "col_index",
        "sample_uid",
        "feature_uid",
        "unit",
        "replicate_ix",
        "value",
    )


@bound(
    "mwtab_nmr_long",
    f"""WITH {_grid(mwtab.NMR, STRICT)}
    SELECT 'F' || doc_id AS file_id, CAST(line_no AS INTEGER) AS line_no, c AS col_index,
      {STUDY_OF} || ':AN' || doc_id || ':s:' || substr(sha1(label), 1, 12) AS sample_uid,
      'AN' || doc_id || ':nmrbin:' || substr(sha1('Feat  ' || r % 40), 1, 12) AS feature_uid,
      {REPLICATE} AS replicate_ix, {V} AS value FROM g""",
)
def mwtab_nmr_long(spark, sf_dir):
    cells = mwtab.Matrices(render(spark, sf_dir, mwtab.NMR), mwtab.NMR).measurements
    return cells.select(
        "file_id", "line_no", "col_index", "sample_uid", "feature_uid", "replicate_ix", "value"
    )


@bound(
    "mwtab_plain_long",
    f"""WITH {_grid(mwtab.PLAIN, PLAIN)}
    SELECT 'F' || doc_id AS file_id, CAST(line_no AS INTEGER) AS line_no,
      {STUDY_OF} || ':' || label AS sample_uid,
      'AN' || doc_id || ':met:feat ' || r % 40 AS feature_uid, {V} AS value FROM g""",
)
def mwtab_plain_long(spark, sf_dir):
    cells = mwtab.Matrices(render(spark, sf_dir, mwtab.PLAIN), mwtab.PLAIN).measurements
    return cells.select("file_id", "line_no", "sample_uid", "feature_uid", "value")


@bound(
    "mwtab_samples",
    f"""WITH lab(label) AS (VALUES ('S1'), ('S2'), ('S3'), ('S4'), ('S5'), ('S6'))
    SELECT 'F' || doc_id AS file_id, {STUDY_OF} || ':' || label AS sample_uid,
      label AS sample_label, CASE WHEN label = 'S1' THEN lang ELSE '' END AS subject,
      CASE WHEN label = 'S1' THEN 'Group:' || source || ' | loose' END AS factors_raw
    FROM documents, lab""",
)
def mwtab_samples(spark, sf_dir):
    found = mwtab.Matrices(render(spark, sf_dir, mwtab.MS), mwtab.MS).samples
    return found.select("file_id", "sample_uid", "sample_label", "subject", "factors_raw")


@bound(
    "mwtab_plain_samples",
    f"""WITH lab(label) AS (VALUES ('S1'), ('S2'), ('S3'), ('S4'), (' S5'), ('S6'), ('S7'), ('S9'))
    SELECT 'F' || doc_id AS file_id, {STUDY_OF} || ':' || label AS sample_uid,
      label AS sample_label, CASE label WHEN 'S1' THEN 'Group:' || source || ' | loose'
        WHEN 'S9' THEN 'Group:none' END AS factors_raw
    FROM documents, lab""",
)
def mwtab_plain_samples(spark, sf_dir):
    found = mwtab.Matrices(render(spark, sf_dir, mwtab.PLAIN), mwtab.PLAIN).samples
    return found.select("file_id", "sample_uid", "sample_label", "factors_raw")


REFMET_SQL = f"""CASE WHEN has6 AND i6 % 11 <> 0 THEN {CELL.replace('i %', 'i6 %').replace('n %', 'n6 %').replace('|| n', '|| n6').replace('cast(n ', 'cast(n6 ')} END"""


@bound(
    "mwtab_features",
    f"""WITH {_grid(mwtab.MS, {1: "S1"})}, f AS (SELECT *, trim({REFMET_SQL}) AS refmet FROM g)
    SELECT 'F' || doc_id AS file_id, 'AN' || doc_id || ':met:feat ' || r AS feature_uid,
      'metabolite' AS feature_type, 'Feat  ' || r AS name_raw, refmet AS refmet_name,
      'AN' || doc_id AS analysis_id FROM f WHERE r < 40""",
)
def mwtab_features(spark, sf_dir):
    return mwtab.Matrices(render(spark, sf_dir, mwtab.MS), mwtab.MS).features


@bound(
    "mwtab_rejects",
    """SELECT 'F' || doc_id AS file_id, CASE WHEN doc_id % 20 = 11
        THEN 'Missing required metadata: study_id'
        ELSE 'Missing required metadata: analysis_id' END AS error
    FROM documents WHERE doc_id % 20 = 11 OR doc_id % 10 = 2""",
)
def mwtab_rejects(spark, sf_dir):
    return mwtab.Matrices(render(spark, sf_dir, mwtab.MS, break_ids=True), mwtab.MS).rejects


@bound(
    "mwtab_metadata",
    f"""SELECT 'F' || doc_id AS file_id, CASE WHEN doc_id % 20 = 11 THEN NULL
        WHEN doc_id % 20 = 1 THEN 'ST7' ELSE {STUDY_OF} END AS study_id,
      CASE WHEN doc_id % 10 = 2 THEN NULL ELSE 'AN' || doc_id END AS analysis_id,
      'unit ' || lang AS unit FROM documents""",
)
def mwtab_metadata(spark, sf_dir):
    files = render(spark, sf_dir, mwtab.NMR, break_ids=True)
    return mwtab.Matrices(files, mwtab.NMR).metadata.select("file_id", "study_id", "analysis_id", "unit")


@bound(
    "mwtab_warnings",
    f"""WITH {_grid(mwtab.PLAIN, PLAIN)}
    SELECT 'F' || doc_id AS file_id, 'unreadable_value' AS kind, count(*) AS n FROM g
      WHERE n IS NOT NULL AND i % 11 <> 0 AND i % 13 <> 5 AND i % 17 = 3 GROUP BY 1
    UNION ALL SELECT 'F' || doc_id, 'factor_line_too_short', 1 FROM documents
    UNION ALL SELECT 'F' || doc_id, 'factor_without_colon', 1 FROM documents""",
)
def mwtab_warnings(spark, sf_dir):
    found = mwtab.Matrices(render(spark, sf_dir, mwtab.PLAIN), mwtab.PLAIN).warnings
    return found.groupBy("file_id", "kind").agg(F.count("*").alias("n"))


# --- files too large for one row ---


def lines_of(spark, sf_dir) -> DataFrame:
    """Three files of lines, stored; a line's number follows its order key."""
    items = table(spark, sf_dir, "lineitem", "l_orderkey")
    data = items.select(
        F.concat(F.lit("L"), "l_returnflag").alias("file_id"),
        (F.lit(100) + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("no"),
        F.concat_ws(
            "\t",
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")),
            F.col("l_quantity").cast("string"),
            F.when(F.col("l_linenumber") % 4 == 0, "NA").otherwise(
                F.col("l_extendedprice").cast("string")
            ),
            F.concat(F.lit("RM"), F.col("l_suppkey").cast("string")),
            F.col("l_discount").cast("string"),
        ).alias("text"),
    )
    frame = [
        (0, "#METABOLOMICS WORKBENCH STUDY_ID:ST1 ANALYSIS_ID:AN1"),
        (1, "MS_METABOLITE_DATA:UNITS\tarea"),
        (2, "MS_METABOLITE_DATA_START"),
        (3, "Samples\tA\tB\trefmet_name\tA"),
        (4, "Factors\tx\ty"),
        (1 << 60, "MS_METABOLITE_DATA_END"),
        ((1 << 60) + 1, "behind\t1\t2"),
    ]
    flags = items.select(F.concat(F.lit("L"), "l_returnflag").alias("file_id")).distinct()
    framed = flags.select(
        "file_id",
        F.inline(
            F.array(
                *[F.struct(F.lit(n).cast("long").alias("no"), F.lit(t).alias("text")) for n, t in frame]
            )
        ),
    )
    return settle(data.unionByName(framed), "lines")


@bound(
    "mwtab_lines_long",
    """SELECT 'L' || l_returnflag AS file_id, 100 + l_orderkey * 10 + l_linenumber AS line_no,
      'AN1:met:part ' || l_partkey AS feature_uid, 'RM' || l_suppkey AS refmet_name,
      c AS col_index, 'ST1:' || label AS sample_uid, rep AS replicate_ix, 'area' AS unit,
      CASE c WHEN 1 THEN l_quantity
             WHEN 2 THEN CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_extendedprice END
             ELSE l_discount END AS value
    FROM lineitem, (VALUES (1, 'A', 1), (2, 'B', 1), (4, 'A', 2)) t(c, label, rep)""",
)
def mwtab_lines_long(spark, sf_dir):
    cells = mwtab_lines.LineMatrices(
        lines_of(spark, sf_dir), mwtab.MS, min_rows=1000, salts=8).measurements
    return cells.select(
        "file_id",
        "line_no",
        "feature_uid",
        "refmet_name",
        "col_index",
        "sample_uid",
        "replicate_ix",
        "unit",
        "value",
    )


# --- parse jobs ---


@bound(
    "parse_selection",
    ctes("files")
    + """SELECT file_id, detected_type,
      detected_type IN ('mwtab', 'mwtab_ms') AND detected_type <> 'mwtab_ms' AS selected
    FROM files WHERE detected_type IN ('mwtab', 'mwtab_ms', 'mwtab_nmr_binned')""",
)
def parse_selection(spark, sf_dir):
    files = load(spark, sf_dir, "files")["files"]
    chosen = parse.parsable_files(files, ["mwtab", "mwtab_ms"], ["mwtab_ms"])
    return chosen.select("file_id", "detected_type", "selected")


@bound(
    "parse_pending",
    ctes("files")
    + """SELECT file_id, detected_type, parse_status FROM files
      WHERE import_id = 'src8' AND parse_status IN ('pending', 'failed')
        AND detected_type NOT IN ('metabo_table_html')
      ORDER BY created_at, file_id LIMIT 12""",
)
def parse_pending(spark, sf_dir):
    files = load(spark, sf_dir, "files")["files"]
    found = parse.pending_files(files, "src8", skip_types=["metabo_table_html"], max_files=12)
    return found.select("file_id", "detected_type", "parse_status")


def _typed_text() -> Column:
    """File text of a document; every fourth document stays as it is."""
    kind = F.col("doc_id") % 4
    content = F.when(kind == 3, F.col("text"))
    for i, layout in enumerate((mwtab.PLAIN, mwtab.MS, mwtab.NMR)):
        content = content.when(kind == i, file_text(layout, break_ids=True))
    return content


def _typed(spark, sf_dir) -> DataFrame:
    """Files of four types, some without ids."""
    types = pick("doc_id", 4, mwtab.PLAIN.name, mwtab.MS.name, mwtab.NMR.name, "unknown")
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id",
        F.format_string("F%d", "doc_id").alias("file_id"),
        _typed_text().alias("content"),
        F.expr(types).alias("detected_type"),
    )


OUTCOMES = """o AS (SELECT 'F' || doc_id AS file_id, CASE doc_id % 4 WHEN 0 THEN 'mwtab'
    WHEN 1 THEN 'mwtab_ms' WHEN 2 THEN 'mwtab_nmr_binned' ELSE 'unknown' END AS detected_type,
  CASE WHEN doc_id % 4 = 3 THEN 'skipped' WHEN doc_id % 20 = 11 OR doc_id % 10 = 2 THEN 'failed'
    ELSE 'success' END AS parse_status,
  CASE WHEN doc_id % 4 = 3 THEN 'Unsupported file type'
    WHEN doc_id % 20 = 11 THEN 'Missing required metadata: study_id'
    WHEN doc_id % 10 = 2 THEN 'Missing required metadata: analysis_id' END AS parse_error
  FROM documents)
"""


def _outcomes(spark, sf_dir):
    files = _typed(spark, sf_dir)
    return parse.outcome(files, parse.Parsed(files).metadata)


@bound("parse_outcome", f"WITH {OUTCOMES} SELECT * FROM o")
def parse_outcome(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@bound(
    "parse_status",
    ctes("files").rstrip()
    + f""", {OUTCOMES}
    SELECT f.file_id, o.parse_status, o.parse_error, '2024-06-01' AS parsed_on
    FROM files f JOIN o ON f.file_id = o.file_id""",
)
def parse_status(spark, sf_dir):
    import datetime

    registry = load(spark, sf_dir, "files")["files"]
    at = datetime.datetime(2024, 6, 1, 12, tzinfo=datetime.timezone.utc)
    done = parse.with_status(registry, _outcomes(spark, sf_dir), at)
    return done.select(
        "file_id", "parse_status", "parse_error", F.date_format("parsed_at", "yyyy-MM-dd").alias("parsed_on")
    )


@bound(
    "parse_stats",
    f"""WITH {OUTCOMES} SELECT count(*) AS files_total,
      count(*) FILTER (WHERE parse_status = 'success') AS files_success,
      count(*) FILTER (WHERE parse_status = 'failed') AS files_failed,
      count(*) FILTER (WHERE parse_status = 'skipped') AS files_skipped FROM o""",
)
def parse_stats(spark, sf_dir):
    return parse.outcome_stats(_outcomes(spark, sf_dir))


@bound(
    "parse_by_type",
    f"""WITH {OUTCOMES} SELECT detected_type, count(*) AS n FROM o
      WHERE parse_status = 'success' GROUP BY 1""",
)
def parse_by_type(spark, sf_dir):
    return parse.parsed_by_type(_outcomes(spark, sf_dir))


MEAS = " AND NOT (doc_id % 20 = 11 OR doc_id % 10 = 2)"
STUDY_BROKEN = f"CASE WHEN doc_id % 20 = 1 THEN 'ST7' ELSE {STUDY_OF} END"


def _count(layout, labels, test):
    return f"""(WITH {_grid(layout, labels)} SELECT count(*) FROM g WHERE {test}{MEAS})"""


@bound(
    "parse_dry_run",
    f"""SELECT 'mwtab' AS layout, {_count(mwtab.PLAIN, PLAIN, 'doc_id % 4 = 0')} AS n
    UNION ALL SELECT 'mwtab_ms', {_count(mwtab.MS, STRICT, 'doc_id % 4 = 1')}
    UNION ALL SELECT 'mwtab_nmr_binned', {_count(mwtab.NMR, STRICT, 'doc_id % 4 = 2')}""",
)
def parse_dry_run(spark, sf_dir):
    """Cells that would be processed, per layout, without writing anything."""
    cells = parse.Parsed(_typed(spark, sf_dir)).measurements
    return cells.groupBy("layout").agg(F.count("*").alias("n"))


@bound(
    "route_by_markers",
    """SELECT 'F' || doc_id AS file_id, CASE doc_id % 4 WHEN 0 THEN 'mwtab' WHEN 1 THEN 'mwtab_ms'
      WHEN 2 THEN 'mwtab_nmr_binned' END AS layout FROM documents""",
)
def route_by_markers(spark, sf_dir):
    layout = mwtab.layout_by_markers(F.col("content"))
    return _typed(spark, sf_dir).select("file_id", layout.alias("layout"))


def _first(layout, labels, test, uid, feature, plain=False):
    """Stored value per (sample, feature): first row wins, or the last non-null value."""
    pick = (
        "arg_max(value, r) FILTER (WHERE value IS NOT NULL)"
        if plain
        else "arg_min(struct_pack(v := value), r * 100 + c).v"
    )
    return f"""SELECT {uid} AS sample_uid, {feature} AS feature_uid, {pick} AS value FROM (
      WITH {_grid(layout, labels)} SELECT *, {V} AS value FROM g WHERE {test}{MEAS}) GROUP BY 1, 2"""


@bound(
    "parse_and_store",
    _first(
        mwtab.PLAIN,
        PLAIN,
        "doc_id % 4 = 0",
        f"{STUDY_BROKEN} || ':' || label",
        "'AN' || doc_id || ':met:feat ' || r % 40",
        plain=True,
    )
    + " UNION ALL "
    + _first(
        mwtab.MS,
        STRICT,
        "doc_id % 4 = 1",
        f"{STUDY_BROKEN} || ':' || label",
        "'AN' || doc_id || ':met:feat ' || r % 40",
    )
    + " UNION ALL "
    + _first(
        mwtab.NMR,
        STRICT,
        "doc_id % 4 = 2",
        f"{STUDY_BROKEN} || ':AN' || doc_id || ':s:' || substr(sha1(label), 1, 12)",
        "'AN' || doc_id || ':nmrbin:' || substr(sha1('Feat  ' || r % 40), 1, 12)",
    ),
)
def parse_and_store(spark, sf_dir):
    """Parse files of all layouts and merge them into an empty store."""
    files = parse.routed(_typed(spark, sf_dir), "detected_type").where("layout IS NOT NULL")
    parsed = parse.StoredParsed(parse.Parsed(files, "layout"), shared_folder(spark, "parsed"))
    change = parse.Changes(parsed, empty_store(spark))
    return change.updated_measurements.select("sample_uid", "feature_uid", "value")


def empty_store(spark) -> dict[str, DataFrame]:
    from assayframe import schemas

    shapes = {
        "studies": schemas.STUDIES,
        "analyses": schemas.ANALYSES,
        "samples": schemas.SAMPLES,
        "features": schemas.FEATURES,
        "measurements": schemas.MEASUREMENTS,
    }
    return {name: spark.createDataFrame([], shape) for name, shape in shapes.items()}
