"""Texts are scanned once, whatever is asked of them."""

import pytest
from pyspark.sql import functions as F

from assayframe.operators import mwtab
from assayframe.streaming import incremental

PLAIN = "\n".join(
    [
        "#METABOLOMICS WORKBENCH STUDY_ID:ST1 ANALYSIS_ID:AN1",
        "#SUBJECT_SAMPLE_FACTORS:\tSUBJECT\tSAMPLE\tFACTORS",
        "SUBJECT_SAMPLE_FACTORS\tu\tA\tGroup:x | loose",
        "SUBJECT_SAMPLE_FACTORS\tu\t\tGroup:x",
        "SUBJECT_SAMPLE_FACTORS\tshort",
        "#DATA",
        "MS_METABOLITE_DATA_START",
        "id\tMetabolite_name\tA\tB",
        "1\tgood\t1.5\tNA",
        "2\tbad\t oops \t2",
        "3",
        "4\t\tno name\t1",
        "cut",
        "MS_METABOLITE_DATA_END",
    ]
)


@pytest.fixture(scope="module")
def files(spark):
    rows = [("F1", PLAIN), ("F2", "no data"), ("F3", None), ("F1", PLAIN), (None, PLAIN)]
    return spark.createDataFrame(rows, "file_id string, content string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_warnings_need_one_scan(files):
    parsed = mwtab.Matrices(files, mwtab.PLAIN)
    assert plan(parsed.warnings).count("LogicalRDD") == 1
    factors = parsed.usable.select("file_id", F.explode("factor_lines").alias("f"))
    apart = mwtab.warnings_of_cells(parsed.marked)
    apart = apart.unionByName(mwtab.warnings_of_lines(factors, parsed.rows))
    assert rows(parsed.warnings) == rows(apart.select(parsed.warnings.columns))
    kinds = {r["kind"] for r in parsed.warnings.collect()}
    assert {"unreadable_value", "factor_line_too_short", "empty_sample_label", "factor_without_colon"} <= kinds


@pytest.mark.parametrize("layout", [mwtab.PLAIN, mwtab.MS])
def test_samples_need_one_scan(files, layout):
    text = F.replace("content", F.lit("id\tMeta"), F.lit("Samples\tMeta" if layout.strict else "id\tMeta"))
    parsed = mwtab.Matrices(files.withColumn("content", text), layout)
    assert plan(parsed.samples).count("LogicalRDD") == 1
    factors = parsed.usable.select("file_id", "study_id", "analysis_id", F.explode("factor_lines").alias("f"))
    labels = mwtab.header_labels(parsed.blocks, layout).unionByName(mwtab.factor_labels(factors))
    assert rows(parsed.samples) == rows(mwtab.join_labels(labels, layout)) != []


def test_a_stream_reads_each_text_once_for_a_layout(files):
    made = files.withColumn("content", F.concat("content", F.sha1("file_id")))
    assert plan(incremental.parsed_stream(made)).count("sha1(cast(file_id") == len(mwtab.LAYOUTS)


def test_a_filter_does_not_compute_the_structure_again(files):
    made = files.withColumn("content", F.concat("content", F.sha1("file_id")))
    parsed = mwtab.Matrices(made, mwtab.MS, need_ids=True)
    assert plan(parsed.measurements).count("sha1(cast(file_id") == 1


def test_a_filter_on_names_does_not_split_a_row_again(files):
    features = mwtab.Matrices(files, mwtab.MS).features
    assert plan(features).count("split(row#") == 1


def test_unreadable_cells_are_those_with_neither_a_value_nor_a_missing_mark(spark):
    texts = ["1.2.3", ".", "", " NA ", "5", "1,000", "bad", " 7e-1 ", "+nan", "0x1p3", "1.0d", " x ", "9" * 400, None]
    cells = spark.createDataFrame([(t,) for t in texts], "raw_value string")
    marked = mwtab.marked_cells(cells.withColumn("raw", F.col("raw_value")))
    apart = mwtab.is_unreadable_number(F.col("raw"))
    told = marked.select("raw", "unreadable", F.when(apart, mwtab.strip(F.col("raw"))).alias("other")).collect()
    assert [r["unreadable"] for r in told] == [r["other"] for r in told]
    assert plan(marked).count("RLIKE") + plan(marked).count("rlike") < 2  # the grammar is tried once


def test_stored_tables_are_written_without_a_sort(spark, files, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from assayframe.plans import parse

    asked = []
    by = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda w, *c: asked.append(c) or by(w, *c))
    parsed = parse.Parsed(files.withColumn("layout", F.lit("mwtab")), "layout")
    stored = parse.StoredParsed(parsed, str(tmp_path))
    assert asked == []
    for name in ("measurements", "samples", "features", "metadata"):
        columns = sorted(getattr(parsed, name).columns)
        assert rows(getattr(stored, name).select(columns)) == rows(getattr(parsed, name).select(columns))
