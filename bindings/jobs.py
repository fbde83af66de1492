"""Jobs over a bucketed store, and over the documents written as files."""

from __future__ import annotations

import datetime
import posixpath

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.operators import export, mwtab
from assayframe.operators.tagging import tag_files
from assayframe.plans import derive_job, ingest, load, parse
from assayframe.session import shared_folder
from assayframe.sources import files as source
from assayframe.sources import tables
from assayframe.sources.places import place
from assayframe.sources.store import Store
from assayframe.streaming import incremental
from bindings.core import REGISTRY, SEG_DEVICE, SEG_EXPOSURE, SEG_MATRIX, bound, ctes, table
from bindings.core import load as load_roles
from bindings.matrices import MEAS, OUTCOMES, PLAIN, STRICT, STUDY_BROKEN, V, _grid, _typed, _typed_text
from bindings.tagging import DEVICE_OF, DEVICE_SQL, EXPOSED, EXPOSURE_SQL, MATRIX, TXT

AT = datetime.datetime(2024, 6, 1, 12, tzinfo=datetime.timezone.utc)
STORED = REGISTRY["parse_and_store"].sql


def _store(spark) -> Store:
    return Store.create(spark, shared_folder(spark, "store"), groups=8, inside=1)


def _load(spark, store: Store, files: DataFrame, batch: str) -> load.JobStats:
    parsed = parse.Parsed(parse.routed(files, "detected_type").where("layout IS NOT NULL"), "layout")
    return load.load(store, files.select("file_id", "detected_type"), parsed, batch, created_at=AT)


# the second batch brings a third of the documents again, with other lengths of words
AGAIN = "(SELECT * REPLACE (replace(text, 'e', 'ee') AS text) FROM documents WHERE doc_id % 3 = 0)"


def _last(layout, labels, test, feature) -> str:
    """The stored values of plain files: the last non-null one, of the second batch if it has any."""
    cells = f"SELECT * FROM (WITH {_grid(layout, labels)} SELECT *, {V} AS value FROM g WHERE {test}{MEAS})"
    again = cells.replace("FROM documents", f"FROM {AGAIN}")
    return f"""SELECT {STUDY_BROKEN} || ':' || label AS sample_uid, {feature} AS feature_uid,
      arg_max(value, batch * 1000000000 + r) FILTER (WHERE value IS NOT NULL) AS value
      FROM (SELECT *, 0 AS batch FROM ({cells}) UNION ALL SELECT *, 1 AS batch FROM ({again})) GROUP BY 1, 2"""


@bound(
    "merge_touched",
    _last(mwtab.PLAIN, PLAIN, "doc_id % 4 = 0", "'AN' || doc_id || ':met:feat ' || r % 40")
    + f" UNION ALL SELECT s.* FROM ({STORED}) s"
    + " WHERE CAST(regexp_extract(feature_uid, '^AN([0-9]+)', 1) AS BIGINT) % 4 <> 0",
)
def merge_touched(spark, sf_dir):
    """Two batches into a store: the second fills and updates plain rows, and adds no strict ones."""
    store = _store(spark)
    files = _typed(spark, sf_dir)
    _load(spark, store, files, "all")
    longer = table(spark, sf_dir, "documents", "doc_id").withColumn(
        "text", F.replace("text", F.lit("e"), F.lit("ee"))
    )
    kinds = files.select("file_id", "detected_type")
    again = (
        longer.where("doc_id % 3 = 0")
        .select(F.format_string("F%d", "doc_id").alias("file_id"), _typed_text().alias("content"))
        .join(kinds, "file_id")
        .withColumn("file_id", F.concat(F.lit("again "), "file_id"))
    )
    _load(spark, store, again, "again")
    return store.read("measurements").select("sample_uid", "feature_uid", "value")


@bound("stream_to_store", STORED)
def stream_to_store(spark, sf_dir):
    """Stream the documents into a store; the second run finds nothing new."""
    store = _store(spark)
    path = f"{sf_dir}/documents.parquet"
    schema = spark.read.parquet(path).schema
    for _ in range(2):
        documents = spark.readStream.schema(schema).parquet(f"{path}*")
        texts = documents.select(
            F.format_string("F%d", "doc_id").alias("file_id"), _typed_text().alias("content")
        )
        query = incremental.merge_available(texts, store, f"{store.root}/checkpoint", "documents", AT)
        query.awaitTermination()
    return store.read("measurements").select("sample_uid", "feature_uid", "value")


GOOD = "NOT (doc_id % 20 = 11 OR doc_id % 10 = 2)"


def _labels(labels, more=()) -> str:
    return ", ".join(f"('{x}')" for x in [*dict.fromkeys(labels.values()), *more])


@bound(
    "job_stats",
    f"""WITH {OUTCOMES}, stored AS ({STORED}),
    samples AS (
      SELECT {STUDY_BROKEN} || ':' || l AS uid FROM documents, (VALUES {_labels(PLAIN, ["S9"])}) t(l)
        WHERE doc_id % 4 = 0 AND {GOOD}
      UNION SELECT {STUDY_BROKEN} || ':' || l FROM documents, (VALUES {_labels(STRICT)}) t(l)
        WHERE doc_id % 4 = 1 AND {GOOD}
      UNION SELECT {STUDY_BROKEN} || ':AN' || doc_id || ':s:' || l FROM documents, (VALUES {_labels(STRICT)}) t(l)
        WHERE doc_id % 4 = 2 AND {GOOD})
    SELECT 'files_total' AS counter, count(*) AS n FROM o
    UNION ALL SELECT 'files_parsed', count(*) FILTER (WHERE parse_status <> 'skipped') FROM o
    UNION ALL SELECT 'files_success', count(*) FILTER (WHERE parse_status = 'success') FROM o
    UNION ALL SELECT 'files_failed', count(*) FILTER (WHERE parse_status = 'failed') FROM o
    UNION ALL SELECT 'files_skipped', count(*) FILTER (WHERE parse_status = 'skipped') FROM o
    UNION ALL SELECT 'samples_created', count(*) FROM samples
    UNION ALL SELECT 'features_created', count(DISTINCT feature_uid) FROM stored
    UNION ALL SELECT 'measurements_inserted', count(*) FROM stored
    UNION ALL SELECT 'type ' || detected_type, count(*) FROM o WHERE parse_status = 'success' GROUP BY 1""",
)
def job_stats(spark, sf_dir):
    """All counters of a load but the warnings, which mwtab_warnings covers."""
    stats = _load(spark, _store(spark), _typed(spark, sf_dir), "all")
    return stats.row(spark).where("counter <> 'warnings_count'")


# --- documents as files ---

FOLDER = f"{SEG_EXPOSURE} || '/' || {SEG_MATRIX} || '/' || {SEG_DEVICE}"
PATH = f"{FOLDER} || '/doc' || doc_id || '.txt'"


def _written(spark, sf_dir, content: Column) -> str:
    """A folder with a file for each document."""
    root = shared_folder(spark, "inbox")
    rows = table(spark, sf_dir, "documents", "doc_id").select(
        F.concat(F.lit(f"{root}/"), F.expr(PATH)).alias("path"), content.cast("binary").alias("content")
    )

    def write(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                system, inside, _ = place(path)
                system.create_dir(posixpath.dirname(inside), recursive=True)
                with system.open_output_stream(inside) as out:
                    out.write(data or b"")
            yield pd.DataFrame({"n": [len(batch)]})

    rows.mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return root


def _listed(layout, labels, test, uid, feature) -> str:
    """Stored strict values with the document they come from."""
    return f"""SELECT doc_id, {uid} AS sample_uid, {feature} AS feature_uid,
      arg_min(struct_pack(v := value), r * 100 + c).v AS value FROM (
      WITH {_grid(layout, labels)} SELECT *, {V} AS value FROM g WHERE {test}{MEAS}) GROUP BY 1, 2, 3"""


# rows of plain files have no file, and their features no analysis
PIPELINE = f"""WITH files AS (
  SELECT doc_id, 'F' AS file_id, {PATH} AS path_rel, 'doc' || doc_id || '.txt' AS filename, 'mwtab' AS detected_type
  FROM documents),
t AS (SELECT *, {TXT} AS txt FROM files),
tagged AS (SELECT doc_id, path_rel, {DEVICE_SQL} AS device, {EXPOSURE_SQL} AS exposure FROM t),
stored AS (SELECT *, CAST(regexp_extract(feature_uid, '^AN([0-9]+)', 1) AS BIGINT) AS doc_id FROM ({STORED}))
SELECT CASE WHEN s.doc_id % 4 > 0 THEN path_rel END AS path_rel,
  CASE WHEN s.doc_id % 4 > 0 THEN device END AS device,
  CASE WHEN s.doc_id % 4 > 0 THEN exposure END AS exposure,
  sample_uid, feature_uid, value, split_part(sample_uid, ':', 1) AS study_id,
  CASE WHEN s.doc_id % 4 > 0 THEN 'AN' || s.doc_id END AS analysis_id,
  '2024-06-01 12:00:00+00:00' AS created_at
FROM stored s JOIN tagged ON s.doc_id = tagged.doc_id"""


@bound("pipeline_export", PIPELINE)
def pipeline_export(spark, sf_dir):
    """Files of a directory through ingest, tags, parse, derivation and export, read back from there."""
    store = _store(spark)
    root = _written(spark, sf_dir, _typed_text())
    load.ingest_into(store, root, "I1", created_at=AT)
    tagged = tag_files(store.read("files")).select(store.read("files").columns)
    store.commit(derive_job.replaced(store, "files", "file_id", tagged), "tag I1")
    load.parse_pending(
        store, lambda due: source.read_texts(spark, listed=due), "I1", "parse I1", created_at=AT
    )
    derive_job.derive_into(store, "derive I1")
    out = shared_folder(spark, "export")
    rows = export.export_long(store.tables(*export.NEEDS, "measurements"))
    tables.write_export(rows, out, find_by=["study_id", "sample_uid"])
    return spark.read.parquet(out).select(
        "path_rel", "device", "exposure", "sample_uid", "feature_uid", "value", "study_id", "analysis_id", "created_at"
    )


RAW = "CASE WHEN doc_id % 4 = 0 THEN 'the same text' ELSE text END"


@bound(
    "ingested_registry",
    f"""WITH d AS (SELECT {PATH} AS path_rel, {RAW} AS content, doc_id FROM documents),
    f AS (SELECT path_rel, 'doc' || doc_id || '.txt' AS filename, '.txt' AS ext, strlen(content) AS size_bytes,
      sha256(content) AS sha256, 'unknown' AS detected_type, 'pending' AS parse_status, 'I1' AS import_id,
      row_number() OVER (PARTITION BY sha256(content), strlen(content) ORDER BY path_rel) AS place FROM d)
    SELECT path_rel, filename, ext, size_bytes, sha256, detected_type, parse_status, import_id FROM f
    WHERE place = 1""",
)
def ingested_registry(spark, sf_dir):
    """Registry rows of files of which many repeat one content."""
    root = _written(spark, sf_dir, F.expr(RAW))
    added = ingest.ingest_directory(spark, root, "I1", created_at=AT).added
    return added.select(
        "path_rel", "filename", "ext", "size_bytes", "sha256", "detected_type", "parse_status", "import_id"
    )


@bound(
    "texts_of_files",
    f"""SELECT {PATH} AS path_rel, length(text) AS n, sha256(text) AS digest FROM documents""",
)
def texts_of_files(spark, sf_dir):
    """Texts of files with a byte-order mark and broken bytes, which both go."""
    broken = F.concat(F.unhex(F.lit("EFBBBF")), F.col("text").cast("binary"), F.unhex(F.lit("FFC0")))
    root = _written(spark, sf_dir, broken)
    texts = source.read_texts(spark, root)
    return texts.select(
        source.relative_path(F.col("file_id"), root).alias("path_rel"),
        F.length("content").cast("long").alias("n"),
        F.sha2(F.col("content").cast("binary"), 256).alias("digest"),
    )


@bound(
    "listed_files",
    f"""SELECT {PATH} AS path_rel, 'doc' || doc_id || '.txt' AS filename, strlen(text) AS size_bytes
    FROM documents""",
)
def listed_files(spark, sf_dir):
    root = _written(spark, sf_dir, F.col("text"))
    return source.list_files(spark, root).select(
        source.relative_path(F.col("path_abs"), root).alias("path_rel"), "filename", "size_bytes"
    )


@bound(
    "export_statistics",
    """SELECT count(*) AS total_rows, greatest(1, ceil(count(*) / 50000.0))::BIGINT AS least_chunks,
      true AS has_bytes FROM lineitem""",
)
def export_statistics(spark, sf_dir):
    """Statistics of a written export; a chunk holds at most 50,000 rows."""
    rows = export.export_long(load_roles(spark, sf_dir), ["sample_uid", "value", "unit"])
    stats = tables.write_export(rows, shared_folder(spark, "export"), chunk_rows=50_000, full_chunks=True)
    made = [(stats.total_rows, stats.total_chunks, stats.file_size_bytes > 0)]
    return spark.createDataFrame(made, "total_rows long, least_chunks long, has_bytes boolean")


# --- derivation as a job ---


def _counted(source_table: str, table_name: str, subject: str) -> str:
    return f"""SELECT count(*) AS processed,
      count(*) FILTER (WHERE NOT already AND found IS NOT NULL) AS {table_name}_{subject}_set,
      count(*) FILTER (WHERE already) AS {table_name}_{subject}_already_set,
      count(*) FILTER (WHERE NOT already AND found IS NULL) AS {table_name}_{subject}_unknown,
      count(*) FILTER (WHERE clash AND NOT already) AS {table_name}_{subject}_conflict FROM {source_table} WHERE sample_uid LIKE 'ST000012:%'"""


DEVICES = ctes(
    "files",
    f="""SELECT files.file_id, lower(path_abs || ' ' || filename) AS txt, coalesce(detected_type, '') AS kind,
      device AS old, lower(d.text) AS head FROM files JOIN documents d ON files.file_id = 'F' || d.doc_id""",
    **DEVICE_OF,
)


@bound(
    "derive_job",
    f"""SELECT f.*, e.processed AS samples_processed, e.* EXCLUDE (processed), m.* EXCLUDE (processed) FROM
    ({DEVICES} SELECT count(*) AS files_processed,
       count(*) FILTER (WHERE device_action = 'set') AS files_device_set,
       count(*) FILTER (WHERE device_action = 'already_set') AS files_device_already_set,
       count(*) FILTER (WHERE device_action = 'unknown') AS files_device_unknown FROM r) f,
    ({EXPOSED} {_counted("ex", "samples", "exposure")}) e,
    ({MATRIX} {_counted("mx", "samples", "matrix")}) m""",
)
def derive_job_stats(spark, sf_dir):
    """One row of counts: devices of all files, exposure and matrix of the samples of one study."""
    t = load_roles(spark, sf_dir, "samples", "measurements", "analyses", "files")
    texts = table(spark, sf_dir, "documents").select(
        F.format_string("F%d", "doc_id").alias("file_id"), F.col("text").alias("content")
    )
    return derive_job.derive_all(t, texts, study_id="ST000012", dry_run=True).stats
