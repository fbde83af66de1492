"""File tags and derived categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.functions import devices, tags
from assayframe.operators import derive, merge
from assayframe.operators.tagging import select_files, tag_files, tag_stats, tag_warnings
from bindings.core import SEG_DEVICE, SEG_EXPOSURE, SEG_MATRIX, bound, ctes, load, table
from bindings.strings import PAIRS_SQL

TXT = "lower(coalesce(path_rel, '') || ' ' || coalesce(filename, ''))"


def rx(pattern: str, text: str = "txt") -> str:
    return f"regexp_matches({text}, '(?i){pattern}')"


GC = rx(r"\bGC[-_\s]?MS\b|\bGCMS\b|\bGC[-_]TOF\b|\b_GC_|\bGC[-_\s]?EI\b|/GC/")
DEVICE_SQL = f"""CASE
  WHEN detected_type IN ('nmr_binned_xlsx', 'nmr_binned_xlsm', 'mwtab_nmr_binned') THEN 'NMR'
  WHEN detected_type IN ('mwtab', 'mwtab_ms', 'metabo_table_html')
    THEN CASE WHEN {GC} THEN 'GCMS' ELSE 'LCMS' END
  WHEN {rx(r"\bNMR\b|\b1H[-_]?NMR\b|\b13C[-_]?NMR\b|/NMR/")} THEN 'NMR'
  WHEN {GC} THEN 'GCMS'
  WHEN {rx(r"\bLC[-_\s]?MS\b|\bLCMS\b|\bHPLC\b|\bUPLC\b|\bUHPLC\b")} THEN 'LCMS' END"""
SAMPLE_TYPE_SQL = f"""CASE WHEN {rx(r"\b(serum|plasma|blood)\b")} THEN 'Serum'
  WHEN {rx(r"\b(urine|urinary)\b")} THEN 'Urine'
  WHEN {rx(r"\b(feces|faeces|stool|fecal|faecal)\b")} THEN 'Feces'
  WHEN {rx(r"\b(csf|cerebrospinal)\b")} THEN 'CSF' END"""
OB = rx(r"\b(OB|obese|obesity|overweight|case|high[-_\s]?BMI)\b|\bBMI[-_]?[>3]\d")
CON = rx(r"\b(CON|control|lean|normal|healthy|reference|low[-_\s]?BMI)\b")
EXPOSURE_SQL = f"CASE WHEN {OB} AND {CON} THEN NULL WHEN {OB} THEN 'OB' WHEN {CON} THEN 'CON' END"
CONFLICT = "Conflicting exposure patterns in path: found both OB and CON indicators"


def _platform_sql() -> str:
    hits = ", ".join(
        f"CASE WHEN {rx(pattern)} THEN '{name}' END"
        for pattern, name in [
            (r"\bESI[-_\s]?pos(itive)?\b", "ESI_pos"),
            (r"\bESI[-_\s]?neg(ative)?\b", "ESI_neg"),
            (r"\bpositive[-_\s]?mode\b", "ESI_pos"),
            (r"\bnegative[-_\s]?mode\b", "ESI_neg"),
            (r"\b[+]ESI\b", "ESI_pos"),
            (r"\b-ESI\b", "ESI_neg"),
            (r"\bAPCI[-_\s]?pos\b", "APCI_pos"),
            (r"\bAPCI[-_\s]?neg\b", "APCI_neg"),
            (r"\bHILIC\b", "HILIC"),
            (r"\bRP\b", "RP"),
            (r"\bC18\b", "C18"),
            (r"\bC8\b", "C8"),
            (r"\bQQQ\b", "QQQ"),
            (r"\btriple[-_\s]?quad\b", "QQQ"),
            (r"\bQTOF\b", "QTOF"),
            (r"\bQ[-_]?TOF\b", "QTOF"),
            (r"\bOrbitrap\b", "Orbitrap"),
            (r"\bTripleTOF\b", "TripleTOF"),
            (r"\bTOF\b", "TOF"),
            (r"\bUPLC\b", "UPLC"),
            (r"\bUHPLC\b", "UHPLC"),
            (r"\bHPLC\b", "HPLC"),
        ]
    )
    # a name that several rules give has the place of the first of them
    first = f"list_filter([{hits}], lambda x, i: x IS NOT NULL AND list_position([{hits}], x) = i)"
    return f"nullif(array_to_string({first}[1:3], '_'), '')"


PLATFORM_SQL = _platform_sql()
TEXTS = ctes("files", t=f"SELECT *, {TXT} AS txt FROM files")


def _files(spark, sf_dir):
    return load(spark, sf_dir, "files", spread={"files": "doc_id"})["files"]


SPREAD = {"samples": "o_orderkey", "measurements": "l_orderkey"}


def _samples(spark, sf_dir):
    return load(spark, sf_dir, "samples", spread=SPREAD)["samples"]


def _text():
    return tags.path_text(F.col("path_rel"), F.col("filename"))


@bound("tag_device", TEXTS + f"SELECT file_id, {DEVICE_SQL} AS device FROM t")
def tag_device(spark, sf_dir):
    tag = tags.device_tag(_text(), F.col("detected_type"))
    return _files(spark, sf_dir).select("file_id", tag.alias("device"))


@bound("tag_sample_type", TEXTS + f"SELECT file_id, {SAMPLE_TYPE_SQL} AS sample_type FROM t")
def tag_sample_type(spark, sf_dir):
    return _files(spark, sf_dir).select("file_id", tags.sample_type_tag(_text()).alias("sample_type"))


@bound(
    "tag_exposure",
    TEXTS
    + f"""SELECT file_id, {EXPOSURE_SQL} AS exposure,
      CASE WHEN {OB} AND {CON} THEN '{CONFLICT}' END AS warning FROM t""",
)
def tag_exposure(spark, sf_dir):
    return _files(spark, sf_dir).select(
        "file_id",
        tags.exposure_tag(_text()).alias("exposure"),
        tags.exposure_warning(_text()).alias("warning"),
    )


@bound("tag_platform", TEXTS + f"SELECT file_id, {PLATFORM_SQL} AS platform FROM t")
def tag_platform(spark, sf_dir):
    return _files(spark, sf_dir).select("file_id", tags.platform_tag(_text()).alias("platform"))


FOUND = TEXTS.rstrip() + f""",
g AS (SELECT *, {DEVICE_SQL} AS d, {EXPOSURE_SQL} AS e, {SAMPLE_TYPE_SQL} AS s,
             {PLATFORM_SQL} AS p, {OB} AND {CON} AS clash FROM t)
"""


@bound(
    "tag_apply_fill",
    FOUND
    + """SELECT file_id, coalesce(device, d) AS device, coalesce(exposure, e) AS exposure,
      coalesce(sample_type, s) AS sample_type, coalesce(platform, p) AS platform,
      (device IS NULL AND d IS NOT NULL) OR (exposure IS NULL AND e IS NOT NULL)
      OR (sample_type IS NULL AND s IS NOT NULL) OR (platform IS NULL AND p IS NOT NULL)
        AS updated FROM g""",
)
def tag_apply_fill(spark, sf_dir):
    tagged = tag_files(select_files(_files(spark, sf_dir), everything=True))
    return tagged.select("file_id", "device", "exposure", "sample_type", "platform", "updated")


@bound(
    "tag_apply_overwrite",
    FOUND
    + """SELECT file_id, coalesce(d, device) AS device, coalesce(e, exposure) AS exposure,
      coalesce(s, sample_type) AS sample_type, coalesce(p, platform) AS platform,
      coalesce(d, e, s, p) IS NOT NULL AS updated FROM g WHERE import_id = 'src7'""",
)
def tag_apply_overwrite(spark, sf_dir):
    chosen = select_files(_files(spark, sf_dir), import_id="src7")
    tagged = tag_files(chosen, overwrite=True)
    return tagged.select("file_id", "device", "exposure", "sample_type", "platform", "updated")


@bound(
    "tag_dry_run",
    FOUND
    + """SELECT file_id, device, platform, device IS NULL AND d IS NOT NULL AS set_device,
      platform IS NULL AND p IS NOT NULL AS set_platform FROM g""",
)
def tag_dry_run(spark, sf_dir):
    tagged = tag_files(_files(spark, sf_dir), dry_run=True)
    return tagged.select("file_id", "device", "platform", "set_device", "set_platform")


@bound(
    "tag_stats",
    FOUND
    + """, u AS (SELECT *, device IS NULL AND d IS NOT NULL AS sd,
        exposure IS NULL AND e IS NOT NULL AS se,
        sample_type IS NULL AND s IS NOT NULL AS ss,
        platform IS NULL AND p IS NOT NULL AS sp,
        device IS NOT NULL AND exposure IS NOT NULL AND sample_type IS NOT NULL
          AND platform IS NOT NULL AS full_set FROM g)
    SELECT count(*) AS files_processed, count(*) FILTER (WHERE sd OR se OR ss OR sp) AS files_updated,
      count(*) FILTER (WHERE NOT (sd OR se OR ss OR sp)) AS files_skipped,
      count(*) FILTER (WHERE sd) AS device_set, count(*) FILTER (WHERE se) AS exposure_set,
      count(*) FILTER (WHERE ss) AS sample_type_set, count(*) FILTER (WHERE sp) AS platform_set,
      count(*) FILTER (WHERE clash AND NOT full_set) AS warning_count FROM u""",
)
def tag_statistics(spark, sf_dir):
    return tag_stats(tag_files(_files(spark, sf_dir)))


@bound(
    "tag_warnings",
    FOUND
    + f"""SELECT file_id, filename || ': {CONFLICT}' AS warning FROM g WHERE clash
      AND NOT (device IS NOT NULL AND exposure IS NOT NULL AND sample_type IS NOT NULL
               AND platform IS NOT NULL)""",
)
def tag_warning_rows(spark, sf_dir):
    return tag_warnings(tag_files(_files(spark, sf_dir)))


# --- derivation ---

SCORES = f"""{PAIRS_SQL},
kv AS (SELECT sample_uid, lower(k) AS k, lower(arg_max(v, i)) AS v FROM pairs GROUP BY sample_uid, lower(k)),
rel AS (SELECT *, translate(k, '_- ', '') AS nk FROM kv),
sc AS (SELECT sample_uid, v, nk,
   regexp_matches(nk, 'group|cohort|exposure|casecontrol|obesity|status|condition|treatment|'
     || 'phenotype|constitution|bmi|category|class|diagnosis') AND v <> 'obesity and hdl function'
   AND (NOT regexp_matches(v, 'exercise|acute|pool|qc|blank|standard|baseline|treatment|intervention')
        OR regexp_matches(v, 'obese|obesity|lean')) AS counts FROM rel),
pts AS (SELECT sample_uid,
   sum(CASE WHEN NOT counts THEN 0 WHEN contains(v, 'ob') THEN CASE WHEN v = 'ob' THEN 10 ELSE 5 END
        WHEN contains(v, 'case') THEN CASE WHEN v = 'case' THEN 10 ELSE 5 END
        WHEN contains(v, 'overweight') THEN CASE WHEN v = 'overweight' THEN 10 ELSE 5 END
        WHEN contains(v, 'bmi>') THEN CASE WHEN v = 'bmi>' THEN 10 ELSE 5 END ELSE 0 END) AS ob,
   sum(CASE WHEN NOT counts THEN 0 WHEN contains(v, 'con') THEN CASE WHEN v = 'con' THEN 10 ELSE 5 END
        WHEN regexp_matches(v, 'lean|normal|healthy|reference')
        THEN CASE WHEN v IN ('lean', 'normal', 'healthy', 'reference') THEN 10 ELSE 5 END
        ELSE 0 END) AS con FROM sc GROUP BY 1),
classes AS (SELECT DISTINCT sample_uid, c FROM (
   SELECT sample_uid, CASE WHEN regexp_matches(v, 'serum|plasma|blood') THEN 'Serum' END AS c, nk FROM rel
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(v, 'urine|urinary') THEN 'Urine' END, nk FROM rel
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(v, 'feces|faeces|stool|fecal|faecal') THEN 'Feces' END, nk FROM rel
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(v, 'csf|cerebrospinal|spinal fluid') THEN 'CSF' END, nk FROM rel
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(v, 'tissue|mammary|liver|muscle|adipose') THEN 'Tissue' END, nk FROM rel)
   WHERE c IS NOT NULL AND regexp_matches(nk, 'matrix|sampletype|biofluid|specimen|sample|tissue|material|source|bodyfluid')),
mc AS (SELECT sample_uid, count(*) AS n, min(c) AS c FROM classes GROUP BY 1)"""
EXPOSED = (
    ctes("samples").rstrip()
    + ","
    + SCORES
    + """, ex AS (SELECT s.sample_uid, s.exposure AS old,
   coalesce(s.exposure, '') <> '' AS already,
   CASE WHEN ob > con THEN 'OB' WHEN con > ob THEN 'CON' END AS found,
   coalesce(ob > 0 AND con > 0, false) AS clash
   FROM samples s LEFT JOIN pts ON s.sample_uid = pts.sample_uid)
"""
)


@bound(
    "derive_exposure",
    EXPOSED
    + """SELECT sample_uid, CASE WHEN already THEN old ELSE coalesce(found, old) END AS exposure,
      clash AND NOT already AS exposure_conflict,
      CASE WHEN already THEN 'already_set' WHEN found IS NOT NULL THEN 'set'
           ELSE 'unknown' END AS exposure_action FROM ex""",
)
def derive_exposure(spark, sf_dir):
    derived = derive.derive_exposure(_samples(spark, sf_dir))
    return derived.select("sample_uid", "exposure", "exposure_conflict", "exposure_action")


# stored factors: one that the raw text repeats (and so replaces), and one that it lacks
OVERLAID = EXPOSED.replace(
    "kv AS (SELECT sample_uid, lower(k) AS k, lower(arg_max(v, i)) AS v FROM pairs GROUP BY sample_uid, lower(k)),",
    """raw AS (SELECT sample_uid, lower(k) AS k, lower(arg_max(v, i)) AS v FROM pairs GROUP BY sample_uid, lower(k)),
kept AS (SELECT sample_uid, 'group' AS k, 'lean' AS v FROM samples
   UNION ALL SELECT sample_uid, 'cohort' AS k,
     CASE CAST(split_part(sample_uid, ':O', 2) AS BIGINT) % 3 WHEN 0 THEN 'obese' WHEN 1 THEN 'control'
       ELSE 'nothing' END AS v FROM samples),
kv AS (SELECT * FROM raw UNION ALL SELECT * FROM kept ANTI JOIN raw USING (sample_uid, k)),""",
)


@bound(
    "derive_exposure_stored",
    OVERLAID
    + """SELECT sample_uid, CASE WHEN already THEN old ELSE coalesce(found, old) END AS exposure,
      clash AND NOT already AS exposure_conflict FROM ex""",
)
def derive_exposure_stored(spark, sf_dir):
    """Stored factors under the raw text's: what the text has replaces them, what it lacks counts."""
    samples = _samples(spark, sf_dir)
    number = F.element_at(F.split("sample_uid", ":O"), 2).cast("long") % 3
    cohort = F.when(number == 0, "Obese").when(number == 1, "control").otherwise("nothing")
    stored = samples.select("sample_uid", F.lit("Group").alias("factor_key"), F.lit("Lean").alias("factor_value"))
    stored = stored.unionByName(
        samples.select("sample_uid", F.lit("COHORT").alias("factor_key"), cohort.alias("factor_value"))
    )
    return derive.derive_exposure(samples, stored).select("sample_uid", "exposure", "exposure_conflict")


MATRIX = (
    ctes("samples", "measurements", "files").rstrip()
    + ","
    + SCORES
    + """, paths AS (SELECT DISTINCT m.sample_uid, lower(f.path_abs) AS p
     FROM measurements m JOIN files f ON m.file_id = f.file_id),
pc AS (SELECT DISTINCT sample_uid, c FROM (
   SELECT sample_uid, CASE WHEN regexp_matches(p, '/(serum|blood serum|plasma|blood)') THEN 'Serum' END AS c FROM paths
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(p, '/(urine|urinary)') THEN 'Urine' END FROM paths
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(p, '/(feces|faeces|stool|fecal|faecal)') THEN 'Feces' END FROM paths
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(p, '/(csf|cerebrospinal|spinal fluid)') THEN 'CSF' END FROM paths
   UNION ALL SELECT sample_uid, CASE WHEN regexp_matches(p, '/(tissue|mammary|liver|muscle|adipose)') THEN 'Tissue' END FROM paths)
   WHERE c IS NOT NULL),
fp AS (SELECT sample_uid, CASE WHEN count(*) = 1 THEN min(c) END AS c FROM pc GROUP BY 1),
mx AS (SELECT s.sample_uid, s.sample_matrix AS old, s.sample_matrix IS NOT NULL AS already,
   coalesce(mc.n > 1, false) AS clash,
   CASE WHEN mc.n = 1 THEN mc.c WHEN mc.n > 1 THEN NULL ELSE fp.c END AS found
   FROM samples s LEFT JOIN mc ON s.sample_uid = mc.sample_uid
   LEFT JOIN fp ON s.sample_uid = fp.sample_uid)
"""
)


@bound(
    "derive_matrix",
    MATRIX
    + """SELECT sample_uid, coalesce(old, found) AS sample_matrix,
      clash AND NOT already AS matrix_conflict,
      CASE WHEN already THEN 'already_set' WHEN found IS NOT NULL THEN 'set'
           ELSE 'unknown' END AS matrix_action FROM mx""",
)
def derive_matrix(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "measurements", "files", spread=SPREAD)
    derived = derive.derive_matrix(t["samples"], None, t["measurements"], t["files"])
    return derived.select("sample_uid", "sample_matrix", "matrix_conflict", "matrix_action")


DEVICE_TEXT = f"""CASE doc_id % 5 WHEN 0 THEN text || ' by HPLC-MS'
  WHEN 1 THEN 'Gas  chromatography' || text WHEN 2 THEN text || ' MS_METABOLITE_DATA_START'
  ELSE text END"""
DEVICE_OF = dict(
    d=f"""SELECT *, CASE WHEN contains(lower(kind), 'nmr') OR
      {rx(r"\bNMR\b|\bnuclear\s+magnetic\s+resonance\b|\b1H[-_\s]?NMR\b|\b13C[-_\s]?NMR\b")} THEN 'NMR' END AS by_name,
      CASE WHEN kind IN ('mwtab', 'mwtab_ms') THEN CASE
        WHEN {rx(r"\bNMR\b|\bnuclear\s+magnetic\s+resonance\b", "head")} THEN 'NMR'
        WHEN {rx(r"\bGC[-_\s]?MS\b|\bGCMS\b|\bgas\s+chromatograph|\bGC\s+mass\s+spectrom", "head")} THEN 'GCMS'
        WHEN {rx(r"\bLC[-_\s]?MS\b|\bLCMS\b|\bliquid\s+chromatograph|\bHPLC[-_\s]?MS\b|\bUHPLC\b|\bUPLC\b", "head")} THEN 'LCMS'
        WHEN contains(head, 'ms_metabolite_data') THEN 'MS' END END AS by_content,
      CASE WHEN {rx(r"\bGC[-_\s]?MS\b|\bGCMS\b|\bgas\s+chromatograph|\bGC\s+mass\s+spectrom")} THEN 'GCMS'
        WHEN {rx(r"\bLC[-_\s]?MS\b|\bLCMS\b|\bliquid\s+chromatograph|\bHPLC[-_\s]?MS\b|\bUHPLC\b|\bUPLC\b")} THEN 'LCMS'
        WHEN contains(kind, 'ms') OR contains(kind, 'metabolite') THEN 'MS' END AS by_path FROM f""",
    r="""SELECT file_id, coalesce(old, by_name, by_content, by_path) AS device,
      CASE WHEN old IS NOT NULL THEN 'already_set'
           WHEN coalesce(by_name, by_content, by_path) IS NOT NULL THEN 'set'
           ELSE 'unknown' END AS device_action FROM d""",
)
DERIVED_DEVICE = ctes(
    f="""SELECT 'F' || doc_id AS file_id, """
    + f"""lower('/data/' || {SEG_EXPOSURE} || '/' || {SEG_DEVICE} || ' run' || doc_id) AS txt,
    CASE doc_id % 4 WHEN 0 THEN 'mwtab' WHEN 1 THEN 'mwtab_ms' WHEN 2 THEN 'x_NMR' ELSE 'other' END AS kind,
    CASE WHEN doc_id % 9 = 0 THEN 'LCMS' END AS old,
    lower({DEVICE_TEXT}) AS head FROM documents""",
    **DEVICE_OF,
)


def _derived_files(spark, sf_dir):
    files = table(spark, sf_dir, "documents", "doc_id").selectExpr(
        "'F' || doc_id AS file_id",
        f"'/data/' || {SEG_EXPOSURE} || '/' || {SEG_DEVICE} AS path_abs",
        "'run' || doc_id AS filename",
        "CASE doc_id % 4 WHEN 0 THEN 'mwtab' WHEN 1 THEN 'mwtab_ms' WHEN 2 THEN 'x_NMR' "
        "ELSE 'other' END AS detected_type",
        "CASE WHEN doc_id % 9 = 0 THEN 'LCMS' END AS device",
        f"{DEVICE_TEXT} AS content",
    )
    return derive.derive_device(files)


@bound("derive_device", DERIVED_DEVICE + "SELECT * FROM r")
def derive_device(spark, sf_dir):
    return _derived_files(spark, sf_dir).select("file_id", "device", "device_action")


@bound(
    "derive_device_analyses",
    DERIVED_DEVICE.rstrip()
    + ", "
    + ctes("analyses")[len("WITH ") :]
    + """SELECT a.analysis_id, coalesce(a.device, r.device) AS device FROM analyses a
      LEFT JOIN r ON a.file_id = r.file_id AND r.device_action = 'set'""",
)
def derive_device_analyses(spark, sf_dir):
    analyses = load(spark, sf_dir, "analyses")["analyses"]
    return derive.propagate_device(analyses, _derived_files(spark, sf_dir)).select(
        "analysis_id", "device"
    )


@bound(
    "derive_stats",
    MATRIX
    + """SELECT count(*) AS processed,
      count(*) FILTER (WHERE NOT already AND found IS NOT NULL) AS "set",
      count(*) FILTER (WHERE already) AS already_set,
      count(*) FILTER (WHERE NOT already AND found IS NULL) AS unknown,
      count(*) FILTER (WHERE clash AND NOT already) AS conflict
    FROM mx WHERE sample_uid LIKE 'ST000012:%'""",
)
def derive_stats(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "measurements", "files", spread=SPREAD)
    chosen = derive.in_scope(t["samples"], "ST000012")
    derived = derive.derive_matrix(chosen, None, t["measurements"], t["files"])
    return derive.action_stats(derived, "matrix", "matrix_conflict")


@bound(
    "derive_warnings",
    EXPOSED
    + """SELECT sample_uid, 'Exposure conflict for sample ' || sample_uid AS warning
      FROM ex WHERE clash AND NOT already""",
)
def derive_warnings(spark, sf_dir):
    derived = derive.derive_exposure(_samples(spark, sf_dir))
    return derive.conflict_warnings(derived, "exposure")


FREE_TEXT = f"""CASE doc_id % 6 WHEN 0 THEN text || ' GC/MS' WHEN 1 THEN 'lc-tof ' || text
  WHEN 2 THEN {SEG_MATRIX} || ' ' || {SEG_EXPOSURE} WHEN 3 THEN {SEG_DEVICE} ELSE text END"""


@bound(
    "classify_texts",
    f"""WITH t AS (SELECT doc_id, lower({FREE_TEXT}) AS txt FROM documents)
    SELECT doc_id,
      CASE WHEN {rx(r"\bnmr\b|\bnuclear\s+magnetic")} THEN 'NMR'
        WHEN {rx(r"\bgc[-_\s]?ms\b|\bgcms\b|\bgas\s+chromatograph|\bgc[/]ms\b|\bgc\s+mass\s*spec|\bgc[-_\s]?tof")} THEN 'GCMS'
        WHEN {rx(r"\blc[-_\s]?ms\b|\blcms\b|\bliquid\s+chromatograph|\bhplc|\buhplc\b|\buplc\b|\blc[/]ms|\blc[-_\s]?tof")} THEN 'LCMS'
        WHEN contains(txt, 'ms') OR contains(txt, 'mass spec') THEN 'MS' END AS device,
      CASE WHEN contains(txt, 'ob') OR contains(txt, 'case') OR contains(txt, 'overweight') THEN 'OB'
        WHEN contains(txt, 'con') OR contains(txt, 'lean') OR contains(txt, 'normal')
          OR contains(txt, 'healthy') THEN 'CON' END AS exposure,
      CASE WHEN regexp_matches(txt, 'serum|plasma|blood') THEN 'Serum'
        WHEN regexp_matches(txt, 'urine|urinary') THEN 'Urine'
        WHEN regexp_matches(txt, 'feces|faeces|stool|fecal') THEN 'Feces'
        WHEN regexp_matches(txt, 'csf|cerebrospinal') THEN 'CSF'
        WHEN regexp_matches(txt, 'tissue|mammary|liver|muscle|adipose') THEN 'Tissue' END AS matrix
    FROM t""",
)
def classify_texts(spark, sf_dir):
    free = F.expr(FREE_TEXT)
    return table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id",
        devices.device_of_text(free).alias("device"),
        devices.exposure_of_text(free).alias("exposure"),
        devices.matrix_of_text(free).alias("matrix"),
    )
