import pytest
from pyspark.sql import functions as F

from assayframe.operators import mwtab, mwtab_lines
from assayframe.plans import parse
from bindings.matrices import empty_store

HEAD = """#METABOLOMICS WORKBENCH test STUDY_ID:ST000001 ANALYSIS_ID:AN000001
VERSION\t1
#SUBJECT_SAMPLE_FACTORS:\tSUBJECT\tSAMPLE\tFACTORS
SUBJECT_SAMPLE_FACTORS\t-\tSample1\tGroup:Control
SUBJECT_SAMPLE_FACTORS\tP2\tSample2\tGroup:Treatment
"""
PLAIN = HEAD + """MS_METABOLITE_DATA:UNITS\tPeak area
MS_METABOLITE_DATA_START
Metabolite_name\tSample1\tSample2
Glucose\t100.5\t200.3
Lactate\t50.2\tNA
MS_METABOLITE_DATA_END
"""
MS = HEAD + """MS_METABOLITE_DATA:UNITS\tarea
MS_METABOLITE_DATA_START
before\t1\t2
Samples\t Sample1\tSample2\trefmet_name\tSample1\tmz
Factors\tGroup:Control\tx
Glucose*\t1\t2\tGlc\t3\t9
#kept\t4\t5\tN/A
\t7\t8
Glucose?\t10
MS_METABOLITE_DATA_END
late\t1\t2
"""
NMR = (HEAD + """NMR_BINNED_DATA:UNITS:ppm
NMR_BINNED_DATA_START
Bin range(ppm)\tSample1\tSample2\tSample1
0.1...0.2\t1\t1,000\tbad
NMR_BINNED_DATA_END
""").replace("\n", "\r\n")


def files(spark, *contents):
    return spark.createDataFrame(
        [(f"f{i}", c) for i, c in enumerate(contents)], "file_id string, content string"
    )


def cells(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_plain_file(spark):
    m = mwtab.Matrices(files(spark, PLAIN), mwtab.PLAIN)
    got = {(r.sample_uid, r.feature_uid): (r.value, r.unit) for r in m.measurements.collect()}
    assert got == {
        ("ST000001:Sample1", "AN000001:met:glucose"): (100.5, "Peak area"),
        ("ST000001:Sample2", "AN000001:met:glucose"): (200.3, "Peak area"),
        ("ST000001:Sample1", "AN000001:met:lactate"): (50.2, "Peak area"),
        ("ST000001:Sample2", "AN000001:met:lactate"): (None, "Peak area"),
    }
    assert cells(m.samples, "sample_label", "subject", "factors_raw") == [
        ("Sample1", "-", "Group:Control"),
        ("Sample2", "P2", "Group:Treatment"),
    ]
    assert m.warnings.count() == 0


def test_file_without_matrix(spark):
    m = mwtab.Matrices(files(spark, HEAD + "#NMR\nNM:INSTRUMENT_NAME\tBruker\n"), mwtab.PLAIN)
    assert m.measurements.count() == 0 and m.features.count() == 0
    assert m.samples.count() == 2 and m.rejects.count() == 0


def test_plain_blocks_repeat_and_last_column_wins(spark):
    text = HEAD + """MS_METABOLITE_DATA_START
Compound\tA\tB\tA
x\t1\t2
alone
MS_METABOLITE_DATA_END
MS_METABOLITE_DATA_START
B\tname\tSample1
5\ty\t6
#NEXT
z\t1\t1
"""
    m = mwtab.Matrices(files(spark, text), mwtab.PLAIN)
    got = cells(m.measurements, "sample_label", "feature_name", F.coalesce("value", F.lit(-1.0)), "known")
    assert got == [
        ("A", "x", -1.0, False),  # short row: the last column of label A has no cell
        ("B", "x", 2.0, True),  # the last header has label B too
        ("B", "y", 5.0, True),
        ("Sample1", "y", 6.0, True),
    ]


def test_ms_file(spark):
    m = mwtab.Matrices(files(spark, MS), mwtab.MS)
    got = cells(
        m.measurements,
        "line_no",
        "col_index",
        "sample_uid",
        "feature_uid",
        F.coalesce("value", F.lit(-1.0)),
        "replicate_ix",
    )
    s1, s2 = "ST000001:Sample1", "ST000001:Sample2"
    g, k = "AN000001:met:glucose", "AN000001:met:kept"
    assert got == [
        (11, 1, s1, g, 1.0, 1),
        (11, 2, s2, g, 2.0, 1),
        (11, 4, s1, g, 3.0, 2),
        (12, 1, s1, k, 4.0, 1),
        (12, 2, s2, k, 5.0, 1),
        (12, 4, s1, k, -1.0, 2),
        (14, 1, s1, g, 10.0, 1),
        (14, 2, s2, g, -1.0, 1),
        (14, 4, s1, g, -1.0, 2),
    ]
    assert cells(m.features, "feature_uid", "name_raw", F.coalesce("refmet_name", F.lit(""))) == [
        (g, "Glucose*", "Glc"),
        (k, "#kept", ""),
    ]


def test_nmr_file(spark):
    m = mwtab.Matrices(files(spark, NMR), mwtab.NMR)
    got = cells(m.measurements, "col_index", F.coalesce("value", F.lit(-1.0)), "replicate_ix", "unit")
    assert got == [(1, 1.0, 1, "ppm"), (2, 1000.0, 1, "ppm"), (3, -1.0, 2, "ppm")]
    assert cells(m.warnings, "kind", "text") == [("unreadable_value", "bad")]
    assert m.samples.count() == 2


def test_first_column_without_known_name_is_no_sample(spark):
    text = NMR.replace("Bin range(ppm)", "my ppm")
    m = mwtab.Matrices(files(spark, text), mwtab.NMR)
    assert cells(m.measurements, "col_index", "known")[0] == (0, False)
    assert m.samples.count() == 2


@pytest.mark.parametrize(
    "head, study, analysis",
    [
        ("#METABOLOMICS WORKBENCH STUDY_ID:A ANALYSIS_ID:B", "A", "B"),
        ("STUDY_ID: x \nSTUDY_ID:y\nANALYSIS_ID:z", "x", "z"),
        ("STUDY_ID:x\n#METABOLOMICS WORKBENCH STUDY_ID:A\nANALYSIS_ID:", "A", None),
        ("#METABOLOMICS WORKBENCH STUDY_ID:A\n#METABOLOMICS WORKBENCH STUDY_ID:C", "C", None),
        ("#metabolomics workbench STUDY_ID:A", None, None),
    ],
)
def test_ids(spark, head, study, analysis):
    for layout in mwtab.LAYOUTS.values():
        row = mwtab.Matrices(files(spark, head), layout).metadata.first()
        assert (row.study_id, row.analysis_id) == (study, analysis)
    assert (row.error is None) == (study is not None and analysis is not None)


def test_units(spark):
    lines = ["{}:UNITS\ta\n{}:UNITS\t", "{}:UNITS:x:y", "{}:UNITS"]
    expect = {"mwtab": ["a", "UNITS:x:y", "UNITS"], "mwtab_ms": ["", "y", "UNITS"]}
    for name, want in expect.items():
        layout = mwtab.LAYOUTS[name]
        df = files(spark, *[t.replace("{}", layout.section) for t in lines])
        got = mwtab.Matrices(df, layout).metadata.orderBy("file_id").collect()
        assert [r.unit for r in got] == want


def test_bad_factor_lines_warn(spark):
    text = """#SUBJECT_SAMPLE_FACTORS:
SUBJECT_SAMPLE_FACTORS\tshort
SUBJECT_SAMPLE_FACTORS\t-\t \tA:1
SUBJECT_SAMPLE_FACTORS\t-\ts\tA:1 | loose
#OTHER
SUBJECT_SAMPLE_FACTORS\tnot in section
"""
    found = mwtab.Matrices(files(spark, text), mwtab.PLAIN).warnings
    assert cells(found, "line_no", "kind") == [
        (2, "factor_line_too_short"),
        (3, "empty_sample_label"),
        (4, "factor_without_colon"),
    ]


def test_lines_give_what_whole_files_give(spark):
    whole = files(spark, MS, MS.replace("Sample2", "T"), PLAIN, NMR)
    lines = whole.select(
        "file_id", F.posexplode(F.split(F.regexp_replace("content", "\r\n", "\n"), "\n"))
    ).select("file_id", (F.col("pos") + 1).alias("no"), F.col("col").alias("text"))
    columns = ["file_id", "line_no", "col_index", "sample_uid", "feature_uid", "replicate_ix", "unit"]
    for layout in (mwtab.MS, mwtab.NMR):
        expected = cells(mwtab.measurements(whole, layout), *columns)
        assert expected
        for min_rows in (1, 1_000_000):  # every file hot, no file hot
            got = mwtab_lines.LineMatrices(lines.repartition(5), layout, min_rows=min_rows, salts=3).measurements
            assert cells(got, *columns) == expected


def test_plain_lines_give_what_whole_files_give(spark):
    blocks = HEAD + """MS_METABOLITE_DATA:UNITS\tu
MS_METABOLITE_DATA_START

Compound\tA\tB\tA
x\t1\t2
alone
MS_METABOLITE_DATA_END
between\t1
MS_METABOLITE_DATA_START
B\tname\tSample1
5\ty\t6
#NEXT
z\t1\t1
"""
    whole = files(spark, PLAIN, blocks, HEAD, "x", MS.replace("ANALYSIS_ID", "no"))
    lines = whole.select("file_id", F.posexplode(F.split("content", "\n"))).select(
        "file_id", (F.col("pos") + 1).alias("no"), F.col("col").alias("text")
    )
    for need_ids in (False, True):
        a = mwtab.Matrices(whole, mwtab.PLAIN, need_ids)
        b = mwtab_lines.LineMatrices(
            lines.repartition(3), mwtab.PLAIN, need_ids=need_ids, min_rows=1, salts=3
        )
        for table in ("measurements", "samples", "features"):
            expected, got = getattr(a, table), getattr(b, table)
            assert sorted(map(str, got.select(expected.columns).collect())) == sorted(
                map(str, expected.collect())
            ), table
    meta = [sorted(map(str, m.metadata.where("study_id IS NOT NULL").collect())) for m in (a, b)]
    assert meta[0] == meta[1]


def test_large_files_from_disk(spark, tmp_path):
    from assayframe.sources.files import line_weights, read_lines, read_texts

    row = "feature {}\t1\t2\tx\t3\t4\n"
    text = MS.replace("Glucose*\t1\t2\tGlc\t3\t9\n", "".join(row.format(i) for i in range(3000)))
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "b.txt").write_text(MS)
    whole = mwtab.measurements(read_texts(spark, str(tmp_path)), mwtab.MS)
    lines = read_lines(spark, str(tmp_path), range_bytes=8_000)  # many ranges per file
    assert lines.rdd.getNumPartitions() > 4
    weights = line_weights(spark, str(tmp_path))
    matrices = mwtab_lines.LineMatrices(lines, mwtab.MS, weights, min_rows=100, salts=4)
    got = matrices.measurements
    assert matrices.samples.count() == 4 and matrices.features.count() > 3000
    columns = ["file_id", "sample_uid", "feature_uid", "replicate_ix", "value"]
    a = [tuple(map(str, r)) for r in got.select(*columns).collect()]
    b = [tuple(map(str, r)) for r in whole.select(*columns).collect()]
    assert sorted(a) == sorted(b) and len(a) > 9000


def test_routing_by_markers(spark):
    df = files(spark, PLAIN, MS, NMR, HEAD)
    got = df.select(mwtab.layout_by_markers(F.col("content")).alias("l"), "file_id")
    assert [r.l for r in got.orderBy("file_id").collect()] == [
        "mwtab",
        "mwtab_ms",
        "mwtab_nmr_binned",
        None,
    ]


def test_store_twice_changes_nothing(spark):
    typed = files(spark, PLAIN, MS.replace("ST000001", "ST2"), NMR.replace("ST000001", "ST3"), "x")
    kinds = F.element_at(
        F.create_map(*[F.lit(x) for kv in zip(("f0", "f1", "f2", "f3"), [*mwtab.LAYOUTS, "unknown"]) for x in kv]),
        F.col("file_id"),
    )
    typed = typed.withColumn("detected_type", kinds)
    parsed = parse.Parsed(typed)
    store = empty_store(spark)
    change = parse.Changes(parsed, store)
    assert change.stats.first().asDict() == {
        "samples_created": 6,
        "features_created": 4,
        "measurements_inserted": 4 + 4 + 2,
    }

    def settle(df):
        """A written table, as a store would have it."""
        rows = df.collect()
        return spark.createDataFrame(rows, df.schema)

    after = {
        "studies": settle(change.new_studies),
        "analyses": settle(change.analyses.drop("_action")),
        "samples": settle(change.samples.drop("_action")),
        "features": settle(change.new_features),
        "measurements": settle(change.updated_measurements.drop("_action")),
    }
    assert after["measurements"].count() == 10
    assert after["measurements"].where("file_id IS NOT NULL").count() == 6
    again = parse.Changes(parsed, after)
    assert again.new_studies.count() == 0 and again.new_features.count() == 0
    assert again.new_measurements.count() == 0
    for table in (again.analyses, again.samples, again.updated_measurements):
        assert table.where("_action IN ('insert', 'update')").count() == 0


def test_outcome_and_fail_fast(spark):
    typed = files(spark, PLAIN, "STUDY_ID:x", "y").withColumn(
        "detected_type", F.when(F.col("file_id") == "f2", "unknown").otherwise("mwtab")
    )
    outcomes = parse.outcome(typed, parse.Parsed(typed).metadata)
    assert cells(outcomes, "file_id", "parse_status", F.coalesce("parse_error", F.lit(""))) == [
        ("f0", "success", ""),
        ("f1", "failed", "Missing required metadata: analysis_id"),
        ("f2", "skipped", "Unsupported file type"),
    ]
    with pytest.raises(RuntimeError, match="f1"):
        parse.stop_on_failure(outcomes)
    parse.stop_on_failure(outcomes.where("file_id <> 'f1'"))


def test_parse_needs_no_shuffle(spark):
    for layout in mwtab.LAYOUTS.values():
        plan = mwtab.measurements(files(spark, MS), layout)._jdf.queryExecution().executedPlan()
        assert "Exchange" not in plan.toString()
