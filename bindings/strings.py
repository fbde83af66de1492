"""Text functions, keys, factors, fingerprints and file types."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.functions import filetypes, keys, text
from assayframe.operators import merge, skew
from assayframe.plans import ingest
from assayframe.sources.files import with_fingerprint
from assayframe.sources.tables import settle
from bindings.core import Role, bound, ctes, load, pick, table

# --- numbers ---

NUMBERS = Role(
    "lineitem",
    {
        "l_orderkey": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "l_partkey": "l_partkey",
        "cell": "CASE (l_orderkey * 7 + l_partkey) % 19 WHEN 0 THEN 'NA' WHEN 1 THEN ' n/a ' "
        "WHEN 2 THEN '-' WHEN 3 THEN '' WHEN 4 THEN '.' WHEN 5 THEN 'null' "
        "WHEN 6 THEN '1,' || lpad(cast(l_partkey % 1000 AS string), 3, '0') || '.5' "
        "WHEN 7 THEN ' ' || l_partkey || ' ' WHEN 8 THEN l_partkey || 'e-3' "
        "WHEN 9 THEN 'about ' || l_partkey WHEN 10 THEN l_partkey || 'd' "
        "WHEN 11 THEN '+' || l_partkey || '.' WHEN 12 THEN '0x1p' || l_partkey "
        "WHEN 13 THEN '1_0' || lpad(cast(l_partkey % 100 AS string), 2, '0') "
        "WHEN 14 THEN '-.5E+2' WHEN 15 THEN '1__0' WHEN 16 THEN '12 345' "
        "WHEN 17 THEN '<' || l_partkey ELSE cast(l_partkey AS string) || '.25' END",
    },
)


@bound(
    "parse_numbers",
    f"""WITH c AS (SELECT *, trim(cell) AS t, replace(replace(trim(cell), ',', ''), ' ', '') AS b
      FROM ({NUMBERS.sql()}))
    SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN upper(t) IN ('', 'NA', 'N/A', 'NULL', '-', '.') THEN NULL
           WHEN regexp_full_match(b, '[+-]?([0-9]+(_[0-9]+)*[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
           THEN TRY_CAST(replace(b, '_', '') AS DOUBLE) END AS value,
      upper(t) NOT IN ('', 'NA', 'N/A', 'NULL', '-', '.') AND
      NOT regexp_full_match(b, '[+-]?([0-9]+(_[0-9]+)*[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
        AS unreadable FROM c""",
)
def parse_numbers(spark, sf_dir):
    rows = NUMBERS.load(spark, sf_dir, "l_orderkey")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        text.parse_number(F.col("cell")).alias("value"),
        text.is_unreadable_number(F.col("cell")).alias("unreadable"),
    )


# --- labels and keys ---

LABELS = Role(
    "part",
    {
        "p_partkey": "p_partkey",
        "label": "'  ' || p_name || CASE p_partkey % 4 WHEN 0 THEN '  #(x)' WHEN 1 THEN '__/' "
        "WHEN 2 THEN ' a.b-c ' ELSE '' END || p_partkey || ' '",
    },
)


@bound(
    "normalize_labels",
    f"""SELECT p_partkey,
      trim(regexp_replace(regexp_replace(trim(label), '[^A-Za-z0-9._-]', '_', 'g'),
           '_+', '_', 'g'), '_') AS sample_label,
      lower(regexp_replace(trim(label), '\\s+', ' ', 'g')) AS feature_name,
      'ST1:' || label AS sample_uid,
      'AN1:met:' || lower(regexp_replace(trim(label), '\\s+', ' ', 'g')) AS feature_uid
    FROM ({LABELS.sql()})""",
)
def normalize_labels(spark, sf_dir):
    label = F.col("label")
    return LABELS.load(spark, sf_dir).select(
        "p_partkey",
        keys.normalize_sample_label(label).alias("sample_label"),
        keys.normalize_feature_name(label).alias("feature_name"),
        keys.sample_uid(F.lit("ST1"), label).alias("sample_uid"),
        keys.feature_uid(F.lit("AN1"), label).alias("feature_uid"),
    )


# whole document texts as names: long ones are hashed, short ones are cleaned
@bound(
    "feature_uids",
    """WITH n AS (SELECT doc_id, text, 'AN' || doc_id % 5 AS an,
        CASE WHEN doc_id % 2 = 0 THEN 'RM ' || doc_id END AS refmet,
        CASE WHEN doc_id % 3 = 0 THEN 'ab (' || doc_id || ')  C' ELSE text END AS name
      FROM documents),
    k AS (SELECT *, lower(regexp_replace(regexp_replace(name, '^\\s+|\\s+$', '', 'g'),
        '\\s+', ' ', 'g')) AS norm FROM n)
    SELECT doc_id,
      an || ':met:' || CASE WHEN length(norm) > 100
        THEN substr(md5(name || '|' || coalesce(refmet, '')), 1, 16)
        ELSE trim(regexp_replace(regexp_replace(norm, '[^a-z0-9._\\-,()` ]', '_', 'g'),
             '_+', '_', 'g'), '_') END AS ms_uid,
      an || ':nmrbin:' || substr(sha1(name), 1, 12) AS bin_uid,
      'UNKNOWN:' || an || ':s:' || substr(sha1(name), 1, 12) AS nmr_sample
    FROM k""",
)
def feature_uids(spark, sf_dir):
    doc, an = F.col("doc_id"), F.expr("'AN' || doc_id % 5")
    refmet = F.expr("CASE WHEN doc_id % 2 = 0 THEN 'RM ' || doc_id END")
    name = F.expr("CASE WHEN doc_id % 3 = 0 THEN 'ab (' || doc_id || ')  C' ELSE text END")
    study = keys.known_or_unknown(F.lit(""))
    return table(spark, sf_dir, "documents").select(
        doc,
        keys.ms_feature_uid(an, name, refmet).alias("ms_uid"),
        keys.nmr_feature_uid(an, name).alias("bin_uid"),
        keys.nmr_sample_uid(study, an, name).alias("nmr_sample"),
    )


# --- factors ---

PAIRS_SQL = """
split AS (SELECT sample_uid, string_split(factors_raw, '|') AS a FROM samples
          WHERE factors_raw NOT IN ('', '-')),
piece AS (SELECT sample_uid, i, trim(a[i]) AS p FROM split, unnest(range(1, len(a) + 1)) t(i)),
pairs AS (SELECT sample_uid, i, trim(substr(p, 1, instr(p, ':') - 1)) AS k,
                 trim(substr(p, instr(p, ':') + 1)) AS v
          FROM piece WHERE contains(p, ':'))
"""


@bound(
    "factors_long",
    ctes("samples").rstrip()
    + ","
    + PAIRS_SQL
    + """SELECT sample_uid, k AS factor_key, arg_max(v, i) AS factor_value FROM pairs
      WHERE k <> '' GROUP BY 1, 2""",
)
def factors_long(spark, sf_dir):
    samples = load(spark, sf_dir, "samples", spread={"samples": "o_orderkey"})["samples"]
    return merge.sample_factors(samples)


@bound(
    "factors_merge",
    ctes("samples").rstrip()
    + ","
    + PAIRS_SQL
    + """, new AS (SELECT sample_uid, k, arg_max(v, i) AS v FROM pairs WHERE k <> '' GROUP BY 1, 2),
    old AS (SELECT sample_uid, 'Group' AS k, 'before' AS v FROM samples
            UNION ALL SELECT sample_uid, 'Visit', '1' FROM samples)
    SELECT coalesce(new.sample_uid, old.sample_uid) AS sample_uid,
      coalesce(new.k, old.k) AS factor_key, coalesce(new.v, old.v) AS factor_value,
      CASE WHEN old.k IS NULL THEN 'insert' WHEN new.k IS NULL THEN 'keep'
           WHEN old.v <> new.v THEN 'update' ELSE 'skip' END AS _action
    FROM new FULL JOIN old ON new.sample_uid = old.sample_uid AND new.k = old.k""",
)
def factors_merge(spark, sf_dir):
    samples = load(spark, sf_dir, "samples")["samples"]
    old = samples.select(
        "sample_uid",
        F.inline(
            F.array(
                F.struct(F.lit("Group").alias("factor_key"), F.lit("before").alias("factor_value")),
                F.struct(F.lit("Visit").alias("factor_key"), F.lit("1").alias("factor_value")),
            )
        ),
    )
    return merge.merge_factors(old, merge.sample_factors(samples))


@bound(
    "replicate_index",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type
        ORDER BY ts, event_id) AS replicate_ix FROM events""",
)
def replicate_index(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    numbered = skew.running_index(
        events, ["user_id", "event_type"], ["ts", "event_id"], F.to_date("ts")
    )
    return numbered.select("event_id", "replicate_ix")


# --- fingerprints, copies, types ---


@bound(
    "content_fingerprint",
    """SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size_bytes,
      CASE WHEN doc_id % 2 = 0 THEN 'results_txt' ELSE 'unknown' END AS detected_type FROM documents""",
)
def content_fingerprint(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("CASE WHEN doc_id % 2 = 0 THEN 'x_res.txt' ELSE 'x.csv' END").alias("filename"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.col("text").cast("binary").alias("content"),
    )
    return with_fingerprint(files).drop("filename")


# a third of the documents gets one and the same content
HOT_TEXT = "CASE WHEN doc_id % 3 = 1 THEN 'the same text' ELSE text END"
# names and contents from which every type can come
NAMED = Role(
    "documents",
    {
        "doc_id": "doc_id",
        "filename": pick(
            "doc_id",
            8,
            "run.txt",
            "run_RES.txt",
            "Normalized Binned Data.XLSX",
            "table.html",
            "page.htm",
            "notes.csv",
            "plain.TXT",
            "archive.exe",
        ),
        "content": "CASE WHEN doc_id % 5 = 0 THEN text || chr(10) || '#Metabolomics Workbench x' "
        "WHEN doc_id % 5 = 1 THEN '#METABOLOMICS WORKBENCH' || chr(10) || text "
        "WHEN doc_id % 5 = 2 THEN text || '<th>METABOLITE_name</th>' ELSE text END",
    },
)
TYPE_SQL = """CASE WHEN contains(lower(filename), '_res.txt') THEN 'results_txt'
  WHEN regexp_matches(lower(filename), '[.]xls[xm]$')
       AND contains(lower(filename), 'normalized binned data') THEN 'nmr_binned_xlsx'
  WHEN lower(filename) LIKE '%.txt' AND len(list_filter(
       string_split(replace(replace(content, chr(13) || chr(10), chr(10)), chr(13), chr(10)),
                    chr(10)),
       lambda l: contains(upper(l), '#METABOLOMICS WORKBENCH'))) > 0 THEN 'mwtab'
  WHEN regexp_matches(lower(filename), '[.]html?$')
       AND contains(lower(content), 'metabolite_name') THEN 'metabo_table_html'
  ELSE 'unknown' END"""


@bound(
    "detect_types",
    f"""SELECT doc_id, lower(regexp_extract(filename, '[.][^.]+$')) AS ext,
      lower(regexp_extract(filename, '[.][^.]+$')) <> '.exe' AS allowed,
      {TYPE_SQL} AS detected_type FROM ({NAMED.sql()})""",
)
def detect_types(spark, sf_dir):
    ext = filetypes.extension_of(F.col("filename"))
    return NAMED.load(spark, sf_dir).select(
        "doc_id",
        ext.alias("ext"),
        filetypes.is_allowed_extension(ext).alias("allowed"),
        filetypes.detected_type(F.col("filename"), F.col("content")).alias("detected_type"),
    )


@bound(
    "mwtab_marker",
    f"""SELECT doc_id, len(list_filter(
       string_split(replace(replace(content, chr(13) || chr(10), chr(10)), chr(13), chr(10)),
                    chr(10)),
       lambda l: contains(upper(l), '#METABOLOMICS WORKBENCH'))) > 0 AS is_mwtab
    FROM ({NAMED.sql()})""",
)
def mwtab_marker(spark, sf_dir):
    marked = filetypes.has_mwtab_marker(F.col("content"))
    return NAMED.load(spark, sf_dir).select("doc_id", marked.alias("is_mwtab"))


def _candidates(spark, sf_dir):
    content = F.expr(HOT_TEXT)
    prints = table(spark, sf_dir, "documents").select(
        F.format_string("F%09d", "doc_id").alias("file_id"),
        F.concat(F.lit("/data/"), F.format_string("%09d", "doc_id")).alias("path_abs"),
        F.col("source").alias("import_id"),
        F.sha2(content.cast("binary"), 256).alias("sha256"),
        F.octet_length(content).cast("long").alias("size_bytes"),
        F.expr(pick("doc_id", 3, "mwtab", "unknown", "results_txt")).alias("detected_type"),
        F.expr(pick("doc_id", 2, ".txt", ".csv")).alias("ext"),
    )
    return settle(prints, "fingerprints")


CANDIDATES = f"""c AS (SELECT printf('F%09d', doc_id) AS file_id, source AS import_id,
  sha256({HOT_TEXT}) AS sha256, strlen({HOT_TEXT}) AS size_bytes,
  {pick("doc_id", 3, "mwtab", "unknown", "results_txt")} AS detected_type,
  {pick("doc_id", 2, ".txt", ".csv")} AS ext FROM documents)"""


@bound(
    "dedup_first_seen",
    f"""WITH {CANDIDATES}
    SELECT file_id, sha256, size_bytes,
      first_value(file_id) OVER w AS canonical_id,
      row_number() OVER w = 1 AS is_new
    FROM c WINDOW w AS (PARTITION BY sha256, size_bytes ORDER BY file_id)""",
)
def dedup_first_seen(spark, sf_dir):
    flagged = merge.mark_first_seen(_candidates(spark, sf_dir), min_rows=50, salts=8)
    return flagged.select("file_id", "sha256", "size_bytes", "canonical_id", "is_new")


REGISTRY_SPLIT = f"""WITH {CANDIDATES},
known AS (SELECT sha256, size_bytes, min(file_id) AS file_id,
                 arg_min(detected_type, file_id) AS detected_type, arg_min(ext, file_id) AS ext
          FROM c WHERE import_id IN ('src0', 'src1', 'src2') GROUP BY 1, 2),
given AS (SELECT * FROM c WHERE import_id NOT IN ('src0', 'src1', 'src2')),
flagged AS (SELECT g.*, k.file_id IS NULL AND
       row_number() OVER (PARTITION BY g.sha256, g.size_bytes ORDER BY g.file_id) = 1 AS is_new,
       coalesce(k.detected_type, first_value(g.detected_type) OVER
         (PARTITION BY g.sha256, g.size_bytes ORDER BY g.file_id)) AS ctype
     FROM given g LEFT JOIN known k ON g.sha256 = k.sha256 AND g.size_bytes = k.size_bytes)
"""


def _flagged(spark, sf_dir):
    """Three sources are in the registry already; all others are ingested."""
    everything = _candidates(spark, sf_dir)
    known = F.col("import_id").isin("src0", "src1", "src2")
    registry = ingest.new_files(
        ingest.compare_with_registry(everything.where(known), None, min_rows=50, salts=8)
    )
    return ingest.compare_with_registry(
        everything.where(~known), registry, min_rows=50, salts=8
    )


@bound(
    "import_summary",
    REGISTRY_SPLIT
    + """SELECT import_id, count(*) AS files_processed,
      count(*) FILTER (WHERE is_new) AS files_new,
      count(*) FILTER (WHERE NOT is_new) AS files_duplicate, 'success' AS status,
      'nightly; ' || count(*) FILTER (WHERE is_new) || ' new, '
        || count(*) FILTER (WHERE NOT is_new) || ' duplicates' AS notes
    FROM flagged GROUP BY 1""",
)
def import_summary(spark, sf_dir):
    counts = ingest.import_counts(_flagged(spark, sf_dir), "import_id")
    return ingest.with_outcome(counts, "nightly")


@bound(
    "import_errors",
    REGISTRY_SPLIT
    + """, counted AS (SELECT import_id, count(*) AS files_processed,
        CASE WHEN import_id = 'src9' THEN 0 ELSE count(*) FILTER (WHERE is_new) END AS files_new,
        count(*) FILTER (WHERE NOT is_new) AS files_duplicate,
        length(import_id) - 4 + CASE WHEN import_id = 'src9' THEN 2 ELSE 0 END AS files_error
      FROM flagged GROUP BY 1)
    SELECT *, CASE WHEN files_error > 0 AND files_new = 0 THEN 'failed' ELSE 'success' END AS status,
      CASE WHEN files_error > 0
           THEN files_new || ' new, ' || files_duplicate || ' dup, ' || files_error || ' errors'
           ELSE files_new || ' new, ' || files_duplicate || ' duplicates' END AS notes
    FROM counted""",
)
def import_errors(spark, sf_dir):
    """Imports with unreadable files: some of all files, and one import without a new file."""
    nine = F.col("import_id") == "src9"
    counts = ingest.import_counts(_flagged(spark, sf_dir), "import_id").withColumns(
        {
            "files_new": F.when(nine, F.lit(0).cast("long")).otherwise(F.col("files_new")),
            "files_error": F.length("import_id") - 4 + F.when(nine, 2).otherwise(0),
        }
    )
    return ingest.with_outcome(counts, errors="files_error")


@bound(
    "ingest_by_type",
    REGISTRY_SPLIT + "SELECT ctype AS detected_type, count(*) AS n FROM flagged GROUP BY 1",
)
def ingest_by_type(spark, sf_dir):
    return ingest.counts_by(_flagged(spark, sf_dir), "detected_type")


@bound(
    "import_log",
    """WITH log AS (SELECT 'I' || user_id AS import_id, event_id AS seq,
        CASE event_type WHEN 'click' THEN 'running' WHEN 'error' THEN 'failed'
             ELSE 'success' END AS status,
        CASE WHEN event_id % 3 = 0 THEN 'note ' || event_id END AS notes,
        '/data/' || event_type AS root_path FROM events)
    SELECT import_id, arg_min(root_path, seq) AS root_path, arg_max(status, seq) AS status,
      arg_max(notes, seq) FILTER (WHERE notes IS NOT NULL) AS notes FROM log GROUP BY 1""",
)
def import_log(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr(
        "'I' || user_id AS import_id",
        "event_id AS seq",
        "CASE event_type WHEN 'click' THEN 'running' WHEN 'error' THEN 'failed' "
        "ELSE 'success' END AS status",
        "CASE WHEN event_id % 3 = 0 THEN 'note ' || event_id END AS notes",
        "'/data/' || event_type AS root_path",
    )
    return ingest.current_imports(log)


@bound(
    "import_files",
    ctes("files")
    + """SELECT file_id, parse_status, created_at FROM files
      WHERE import_id = 'src4' AND parse_status = 'pending' ORDER BY created_at, file_id""",
)
def import_files(spark, sf_dir):
    files = load(spark, sf_dir, "files")["files"]
    found = ingest.import_files(files, "src4", "pending")
    return found.select("file_id", "parse_status", "created_at")
