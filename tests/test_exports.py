"""Exports in chunks and previews, without one task that sees all rows."""

import datetime

from pyspark.sql import functions as F

from assayframe import schemas
from assayframe.operators import export
from assayframe.sources import tables


def test_full_chunks_from_many_tasks(spark, tmp_path):
    rows = spark.range(1003, numPartitions=9).withColumn("text", F.col("id").cast("string"))
    path = str(tmp_path / "out")
    stats = tables.write_export(rows, path, chunk_rows=50, full_chunks=True)
    assert (stats.total_rows, stats.total_chunks) == (1003, 21)
    back = spark.read.parquet(path)
    sizes = [r["n"] for r in back.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sorted(sizes) == [3] + [50] * 20
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    none = tables.write_export(rows.where("id < 0"), str(tmp_path / "none"), full_chunks=True)
    assert (none.total_rows, none.total_chunks) == (0, 0)


def test_preview_joins_few_measurements(spark):
    at = datetime.datetime(2024, 1, 1)

    def empty(shape):
        return spark.createDataFrame([], shape)

    def facts(files):
        found = [(f"m{i}", f"s{i}", f"f{i % 3}", f, i % 4 if i % 5 else None, float(i), at) for i, f in enumerate(files)]
        shape = "measurement_id string, sample_uid string, feature_uid string, file_id string, col_index int, value double, created_at timestamp"
        return schemas.conform(spark.createDataFrame(found, shape), schemas.MEASUREMENTS)

    given = [(f"F{i}",) for i in (1, 2, 2)]  # a key that repeats
    dims = {"files": schemas.conform(spark.createDataFrame(given, "file_id string"), schemas.FILES)}
    for name, shape in (("samples", schemas.SAMPLES), ("features", schemas.FEATURES), ("studies", schemas.STUDIES), ("analyses", schemas.ANALYSES)):
        dims[name] = empty(shape)
    for files in (["F1", "F2", "F9", None] * 20, [None, "F9"] * 8, ["F2"], []):
        t = dims | {"measurements": facts(files)}
        for limit in (1, 10, 200):
            whole = export.export_long(t)
            order = [F.asc_nulls_last(c) for c in (*export.ORDER, "sample_uid", "value", "replicate_ix", "unit", "created_at")]
            want = whole.orderBy(*order).limit(limit).collect()
            assert export.preview(t, limit).collect() == want
    t = dims | {"measurements": facts(["F1", "F2", "F9", None] * 20)}
    assert export._first_measurements(t["measurements"], t["files"], 1).count() < 20


def test_files_join_the_star_last(spark):
    """Their rows are the widest; the keys that were joined before do not travel to them."""
    columns = {
        "measurements": "measurement_id string, sample_uid string, feature_uid string, value double, unit string, "
        "file_id string, col_index int, replicate_ix int, created_at timestamp",
        "files": "file_id string, path_rel string",
        "samples": "sample_uid string, study_pk string",
        "features": "feature_uid string, analysis_id string",
        "studies": "study_pk string, study_id string",
        "analyses": "analysis_id string, study_pk string",
    }
    tables = {name: spark.createDataFrame([], shape) for name, shape in columns.items()}
    plan = export.star(**tables)._jdf.queryExecution().analyzed().toString()
    last = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "f_file_id" in last and "s_sample_uid" in last and "m_sample_uid" not in last


def test_rows_without_a_file_meet_their_samples_whatever_is_missing(spark):
    facts = [("S1", "F1", None, 1.0), ("S1", "F1", "f", 2.0), ("lost", "lost", None, None), (None, None, None, 3.0)]
    tables = {
        "measurements": spark.createDataFrame(facts, "sample_uid string, feature_uid string, file_id string, value double"),
        "files": spark.createDataFrame([("f", "p"), (None, "none")], "file_id string, path_rel string"),
        "samples": spark.createDataFrame([("S1", "1"), (None, "1")], "sample_uid string, study_pk string"),
        "features": spark.createDataFrame([("F1", "a")], "feature_uid string, analysis_id string"),
        "studies": spark.createDataFrame([("1", "ST1")], "study_pk string, study_id string"),
        "analyses": spark.createDataFrame([("a", "1")], "analysis_id string, study_pk string"),
    }
    found = export.export_long(tables, ["path_rel", "sample_uid", "feature_uid", "study_id", "analysis_id", "value"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [
            (None, "S1", "F1", "ST1", "a", 1.0),
            ("p", "S1", "F1", "ST1", "a", 2.0),
            (None, None, None, None, None, None),
            (None, None, None, None, None, 3.0),
        ],
        key=repr,
    )
