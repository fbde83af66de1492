"""QC, export and reports over the star of measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.operators import export, qc
from assayframe.plans import reports
from assayframe.session import shared_folder
from assayframe.sources import tables
from bindings.core import QC_MEASUREMENTS, ROLES, bound, ctes, load

STAR = tuple(ROLES)
QC_WITH = ctes("samples", "features", "studies", m=QC_MEASUREMENTS.sql())


SPREAD = {"measurements": "l_orderkey"}


def qc_rows(spark, sf_dir):
    return QC_MEASUREMENTS.load(spark, sf_dir)


# --- QC ---

COUNTS = """
  count(*) AS total_measurements, count(value) AS non_null_values,
  count(*) FILTER (WHERE isnan(value)) AS nan_count,
  count(*) FILTER (WHERE value = 'Infinity'::DOUBLE) AS pos_inf_count,
  count(*) FILTER (WHERE value = '-Infinity'::DOUBLE) AS neg_inf_count,
  count(*) FILTER (WHERE value < 0 AND value <> '-Infinity'::DOUBLE) AS negative_values_count,
  count(*) - count(value) AS null_count,
  round((count(*) - count(value)) * 100.0 / count(*), 6) AS null_percent"""


@bound("qc_basic", QC_WITH + f"SELECT {COUNTS} FROM m")
def qc_basic(spark, sf_dir):
    counted = qc.value_counts(qc_rows(spark, sf_dir))
    return counted.withColumn("null_percent", F.round("null_percent", 6))


@bound(
    "qc_duplicates",
    QC_WITH
    + """SELECT count(*) AS duplicate_pairs_count FROM (
        SELECT 1 FROM m GROUP BY sample_uid, feature_uid HAVING count(*) > 1)""",
)
def qc_duplicates(spark, sf_dir):
    return qc.duplicate_pairs(qc_rows(spark, sf_dir))


@bound(
    "qc_orphan_samples",
    QC_WITH
    + """SELECT DISTINCT sample_uid FROM m
        WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.sample_uid = m.sample_uid)""",
)
def qc_orphan_samples(spark, sf_dir):
    return qc.orphans(qc_rows(spark, sf_dir), load(spark, sf_dir, "samples")["samples"], "sample_uid")


@bound(
    "qc_orphan_features",
    QC_WITH
    + """SELECT count(DISTINCT m.feature_uid) AS orphan_feature_count
        FROM m LEFT JOIN features f ON m.feature_uid = f.feature_uid
        WHERE f.feature_uid IS NULL""",
)
def qc_orphan_features(spark, sf_dir):
    features = load(spark, sf_dir, "features")["features"]
    return qc.orphan_count(qc_rows(spark, sf_dir), features, "feature_uid", "orphan_feature_count")


@bound(
    "qc_top_units",
    QC_WITH
    + """SELECT coalesce(unit, '<NULL>') AS unit, count(*) AS n FROM m
        GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
)
def qc_top_units(spark, sf_dir):
    return qc.top_units(qc_rows(spark, sf_dir))


@bound(
    "qc_top_null_features",
    QC_WITH
    + """SELECT feature_uid, count(*) AS null_count FROM m WHERE value IS NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def qc_top_null_features(spark, sf_dir):
    return qc.top_null_features(qc_rows(spark, sf_dir))


STUDY, ANALYSIS = "ST000007", "AN000003"


@bound(
    "qc_filtered",
    QC_WITH
    + f"""SELECT {COUNTS} FROM m WHERE sample_uid IN (
          SELECT sample_uid FROM samples s JOIN studies st ON s.study_pk = st.study_pk
          WHERE st.study_id = '{STUDY}')""",
)
def qc_filtered(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "studies")
    rows = qc.filter_measurements(qc_rows(spark, sf_dir), t["samples"], t["studies"], STUDY)
    return qc.value_counts(rows).withColumn("null_percent", F.round("null_percent", 6))


@bound(
    "qc_filtered_analysis",
    QC_WITH
    + f"""SELECT feature_uid, count(*) AS n FROM m WHERE feature_uid LIKE '{ANALYSIS}:%'
          GROUP BY 1""",
)
def qc_filtered_analysis(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "studies")
    rows = qc.filter_measurements(
        qc_rows(spark, sf_dir), t["samples"], t["studies"], analysis_id=ANALYSIS
    )
    return rows.groupBy("feature_uid").agg(F.count("*").alias("n"))


def _report(rows: str = "true", samples: str = "true") -> str:
    """Parts of the report over the chosen measurements and samples."""
    return (
        QC_WITH.rstrip()
        + f""",
r AS (SELECT * FROM m WHERE {rows}),
c AS (SELECT {COUNTS} FROM r),
d AS (SELECT count(*) AS dup FROM (
      SELECT 1 FROM r GROUP BY sample_uid, feature_uid HAVING count(*) > 1)),
os AS (SELECT count(DISTINCT sample_uid) AS n FROM r
       WHERE sample_uid NOT IN (SELECT sample_uid FROM samples)),
oft AS (SELECT count(DISTINCT feature_uid) AS n FROM r
       WHERE feature_uid NOT IN (SELECT feature_uid FROM features)),
s AS (SELECT count(*) AS total, count(*) FILTER (WHERE factors_raw IS NULL) AS bare
      FROM samples WHERE {samples})
"""
    )


REPORT = _report()
OF_STUDY = f"study_pk IN (SELECT study_pk FROM studies WHERE study_id = '{STUDY}')"


GRADES = """
SELECT 'total_measurements' AS metric, total_measurements AS value,
       CASE WHEN total_measurements > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM c
UNION ALL SELECT 'non_null_values', non_null_values, '' FROM c
UNION ALL SELECT 'null_count', null_count, CASE WHEN null_percent > 50 THEN 'HIGH'
                 WHEN null_percent > 20 THEN 'WARN' ELSE 'OK' END FROM c
UNION ALL SELECT 'duplicate_pairs_count', dup, CASE WHEN dup = 0 THEN 'OK' ELSE 'ISSUE' END FROM d
UNION ALL SELECT 'nan_count', nan_count, CASE WHEN nan_count = 0 THEN 'OK' ELSE 'WARN' END FROM c
UNION ALL SELECT 'pos_inf_count', pos_inf_count,
                 CASE WHEN pos_inf_count = 0 THEN 'OK' ELSE 'WARN' END FROM c
UNION ALL SELECT 'neg_inf_count', neg_inf_count,
                 CASE WHEN neg_inf_count = 0 THEN 'OK' ELSE 'WARN' END FROM c
UNION ALL SELECT 'negative_values_count', negative_values_count,
                 CASE WHEN negative_values_count * 100.0 / total_measurements > 10
                      THEN 'WARN' ELSE 'OK' END FROM c
UNION ALL SELECT 'orphan_sample_count', n, CASE WHEN n = 0 THEN 'OK' ELSE 'ISSUE' END FROM os
UNION ALL SELECT 'orphan_feature_count', n, CASE WHEN n = 0 THEN 'OK' ELSE 'ISSUE' END FROM oft
UNION ALL SELECT 'samples_total', total, '' FROM s
UNION ALL SELECT 'samples_no_factors', bare,
                 CASE WHEN bare * 100.0 / total > 50 THEN 'WARN' ELSE 'OK' END FROM s"""


@bound("qc_report", REPORT + GRADES)
def qc_report(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "features")
    return qc.graded(qc.summary(qc_rows(spark, sf_dir), t["samples"], t["features"]))


@bound(
    "qc_report_filtered",
    _report(
        f"sample_uid IN (SELECT sample_uid FROM samples WHERE {OF_STUDY}) "
        f"AND feature_uid LIKE '{ANALYSIS}:%'",
        OF_STUDY,
    )
    + GRADES,
)
def qc_report_filtered(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "features", "studies")
    rows = qc_rows(spark, sf_dir)
    return qc.graded(
        qc.summary(rows, t["samples"], t["features"], t["studies"], STUDY, ANALYSIS)
    )


@bound(
    "qc_issues",
    REPORT
    + """
SELECT dup || ' duplicate pairs' AS issue FROM d WHERE dup > 0
UNION ALL SELECT n || ' orphan samples' FROM os WHERE n > 0
UNION ALL SELECT n || ' orphan features' FROM oft WHERE n > 0
UNION ALL SELECT 'high NULL rate (' || printf('%.1f', null_percent) || '%)' FROM c
          WHERE null_percent > 50""",
)
def qc_issues(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "features")
    return qc.issues(qc.summary(qc_rows(spark, sf_dir), t["samples"], t["features"]))


# --- export ---

FROM_STAR = """FROM measurements m
LEFT JOIN files f ON m.file_id = f.file_id
LEFT JOIN samples s ON m.sample_uid = s.sample_uid
LEFT JOIN features ft ON m.feature_uid = ft.feature_uid
LEFT JOIN studies st ON s.study_pk = st.study_pk
LEFT JOIN analyses a ON ft.analysis_id = a.analysis_id AND a.study_pk = st.study_pk
"""
EXPORT = (
    ctes(*STAR)
    + """SELECT f.file_id, f.path_rel, f.detected_type, f.device, f.exposure, f.sample_type,
  f.platform, s.sample_uid, s.sample_label, ft.feature_uid, ft.feature_type,
  ft.name_raw AS feature_name, ft.refmet_name, m.value, m.unit,
  CAST(m.col_index AS DOUBLE) AS col_index, CAST(m.replicate_ix AS DOUBLE) AS replicate_ix,
  st.study_id, a.analysis_id,
  strftime(m.created_at, '%Y-%m-%d %H:%M:%S') || '+00:00' AS created_at
"""
    + FROM_STAR
)


@bound("export_long", EXPORT)
def export_long(spark, sf_dir):
    return export.in_export_order(export.export_long(load(spark, sf_dir, spread=SPREAD)))


@bound(
    "export_filtered",
    EXPORT + "WHERE f.import_id = 'src3' AND ft.feature_type = 'metabolite'",
)
def export_filtered(spark, sf_dir):
    return export.export_long(load(spark, sf_dir), import_id="src3", feature_type="metabolite")


@bound("export_study", EXPORT + f"WHERE st.study_id = '{STUDY}'")
def export_study(spark, sf_dir):
    return export.export_long(load(spark, sf_dir), study_id=STUDY)


@bound(
    "export_preview",
    EXPORT
    + """ORDER BY f.file_id NULLS LAST, m.col_index NULLS LAST, ft.feature_uid NULLS LAST,
      s.sample_uid NULLS LAST, m.value NULLS LAST, m.replicate_ix NULLS LAST,
      m.unit NULLS LAST, m.created_at NULLS LAST LIMIT 10""",
)
def export_preview(spark, sf_dir):
    return export.preview(load(spark, sf_dir))


@bound("export_count", ctes(*STAR) + "SELECT count(*) AS row_count " + FROM_STAR)
def export_count(spark, sf_dir):
    return export.export_count(load(spark, sf_dir))


@bound(
    "export_count_filtered",
    ctes(*STAR)
    + "SELECT count(*) AS row_count "
    + FROM_STAR
    + f"WHERE f.import_id = 'src5' AND ft.feature_type = 'nmr_bin' AND st.study_id = '{STUDY}'",
)
def export_count_filtered(spark, sf_dir):
    return export.export_count(
        load(spark, sf_dir), import_id="src5", feature_type="nmr_bin", study_id=STUDY
    )


@bound(
    "long_view",
    ctes(*STAR)
    + """SELECT m.measurement_id, s.sample_uid, s.sample_label, s.exposure, s.sample_matrix,
  f.file_id, f.device, f.detected_type, f.filename, ft.feature_uid, ft.feature_type,
  ft.name_raw AS feature, ft.refmet_name, m.value, m.unit, m.col_index, m.replicate_ix,
  st.study_id, a.analysis_id """
    + FROM_STAR,
)
def long_view(spark, sf_dir):
    return export.long_view(load(spark, sf_dir, spread=SPREAD))


# --- reports ---


@bound(
    "study_overview",
    ctes(
        "studies",
        "analyses",
        "samples",
        "features",
        "measurements",
        sc="SELECT study_pk, count(DISTINCT sample_uid) AS n FROM samples GROUP BY 1",
        mc="""SELECT s.study_pk, count(*) AS n FROM measurements m
              JOIN samples s ON m.sample_uid = s.sample_uid GROUP BY 1""",
        fc="""SELECT a.analysis_id, count(DISTINCT f.feature_uid) AS n FROM
              (SELECT DISTINCT analysis_id FROM analyses) a
              JOIN features f ON f.feature_uid LIKE a.analysis_id || ':%' GROUP BY 1""",
    )
    + """SELECT st.study_id, a.analysis_id, coalesce(sc.n, 0) AS samples,
      coalesce(fc.n, 0) AS features, coalesce(mc.n, 0) AS measurements
    FROM studies st LEFT JOIN analyses a ON a.study_pk = st.study_pk
    LEFT JOIN sc ON sc.study_pk = st.study_pk LEFT JOIN mc ON mc.study_pk = st.study_pk
    LEFT JOIN fc ON fc.analysis_id = a.analysis_id""",
)
def study_overview(spark, sf_dir):
    t = load(spark, sf_dir)
    return reports.study_overview(
        t["studies"], t["analyses"], t["samples"], t["features"], t["measurements"]
    )


@bound(
    "samples_of_study",
    ctes("samples", "studies")
    + f"""SELECT sample_uid, sample_label, factors_raw FROM samples
      WHERE study_pk = (SELECT study_pk FROM studies WHERE study_id = '{STUDY}')
      ORDER BY sample_uid LIMIT 10""",
)
def samples_of_study(spark, sf_dir):
    t = load(spark, sf_dir, "samples", "studies")
    return reports.samples_of_study(t["samples"], t["studies"], STUDY)


@bound(
    "features_by_prefix",
    ctes("features")
    + f"""SELECT feature_uid, name_raw, feature_type FROM features
      WHERE feature_uid LIKE '{ANALYSIS}:%' ORDER BY feature_uid LIMIT 10""",
)
def features_by_prefix(spark, sf_dir):
    return reports.features_of_analysis(load(spark, sf_dir, "features")["features"], ANALYSIS)


SAMPLE = "ST000007:O32"


@bound(
    "sample_measurements",
    ctes("measurements", "features")
    + f"""SELECT f.name_raw, m.value, m.unit FROM measurements m
      JOIN features f ON f.feature_uid = m.feature_uid
      WHERE m.sample_uid = '{SAMPLE}' ORDER BY f.name_raw""",
)
def sample_measurements(spark, sf_dir):
    t = load(spark, sf_dir, "measurements", "features")
    return reports.measurements_of_sample(t["measurements"], t["features"], SAMPLE)


@bound(
    "study_counts",
    ctes("measurements", "samples", "studies")
    + """SELECT st.study_id, count(*) AS measurement_count FROM measurements m
      JOIN samples s ON s.sample_uid = m.sample_uid
      JOIN studies st ON st.study_pk = s.study_pk GROUP BY 1""",
)
def study_counts(spark, sf_dir):
    t = load(spark, sf_dir, "measurements", "samples", "studies")
    return reports.measurements_per_study(t["measurements"], t["samples"], t["studies"])


@bound(
    "latest_files",
    ctes("files")
    + """SELECT file_id, filename, detected_type, created_at FROM files
      WHERE detected_type = 'mwtab' ORDER BY created_at DESC, file_id LIMIT 20""",
)
def latest_files(spark, sf_dir):
    return reports.latest_files(load(spark, sf_dir, "files")["files"], "mwtab")


@bound(
    "exported_ob",
    ctes(*STAR)
    + "SELECT s.sample_uid, ft.name_raw AS feature_name, m.value "
    + FROM_STAR
    + "WHERE f.exposure = 'CON' AND f.device = 'MS'",
)
def exported_ob(spark, sf_dir):
    """Filter and project a written export, in the order of the columns to find by."""
    columns = ["sample_uid", "feature_name", "value"]
    rows = export.export_long(load(spark, sf_dir), [*columns, "exposure", "device"])
    out = shared_folder(spark, "export")
    tables.write_export(rows, out, find_by=["device", "exposure"])
    return reports.exported_where(spark.read.parquet(out), *columns, exposure="CON", device="MS")


@bound(
    "type_means",
    ctes("measurements", "files")
    + """SELECT f.sample_type, count(*) AS n, round(avg(m.value), 4) AS mean_value
      FROM measurements m LEFT JOIN files f ON m.file_id = f.file_id GROUP BY 1""",
)
def type_means(spark, sf_dir):
    rows = export.export_long(load(spark, sf_dir), ["sample_type", "value"])
    return reports.means_by_sample_type(rows).withColumn("mean_value", F.round("mean_value", 4))
