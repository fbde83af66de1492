import datetime
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from assayframe import schemas
from assayframe.operators import export, mwtab, qc, tagging
from assayframe.operators.mwtab_lines import LineMatrices
from assayframe.plans import ingest, parse
from assayframe.session import shared_folder
from assayframe.sources import files as source
from assayframe.sources import tables
from assayframe.streaming import incremental
from bindings.matrices import empty_store
from tests.test_mwtab import HEAD, MS, NMR, PLAIN


@pytest.fixture
def folder(tmp_path):
    def put(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    put("a.txt", PLAIN)
    put("sub dir/b.TXT", MS)
    put("sub dir/copy of a.txt", PLAIN)
    put("deep/er/c_res.txt", "x")
    put("page.html", "<th>Metabolite_name</th>")
    put("bin.pdf", bytes(range(256)))
    put("empty.csv", b"")
    put("skip.exe", "x")
    put("none", "x")
    return str(tmp_path), put


def test_known_digests(spark, folder):
    root, put = folder
    big = b"a" * (1 << 20)
    put("big.csv", big)
    rows = source.with_fingerprint(source.read_files(spark, root)).collect()
    by_name = {r.filename: r for r in rows}
    assert by_name["empty.csv"].sha256 == hashlib.sha256(b"").hexdigest()
    assert by_name["bin.pdf"].sha256 == hashlib.sha256(bytes(range(256))).hexdigest()
    assert by_name["big.csv"].sha256 == hashlib.sha256(big).hexdigest()
    assert by_name["big.csv"].size_bytes == 1 << 20


def test_odd_names_have_one_path_everywhere(spark, tmp_path):
    odd = tmp_path / "a b+c%20é.txt"
    odd.write_text(PLAIN)
    paths = [
        source.list_files(spark, str(tmp_path)).first().path_abs,
        source.read_texts(spark, str(tmp_path)).first().file_id,
        source.read_lines(spark, str(tmp_path)).first().file_id,
    ]
    assert paths == [str(odd)] * 3


def test_ingest_directory(spark, folder):
    root, put = folder
    report = ingest.ingest_directory(spark, root, "I1", user_notes="first")
    assert (report.files_found, report.files_processed) == (7, 7)
    assert (report.files_new, report.files_duplicate, report.files_skipped) == (6, 1, 2)
    assert report.notes == "first; 6 new, 1 duplicates" and report.status == "success"
    assert report.by_type == {"mwtab": 3, "results_txt": 1, "metabo_table_html": 1, "unknown": 2}
    assert report.by_extension == {".txt": 4, ".html": 1, ".pdf": 1, ".csv": 1}
    added = {r.path_rel: r for r in report.added.collect()}
    assert set(added) == {
        "a.txt",
        "sub dir/b.TXT",
        "deep/er/c_res.txt",
        "page.html",
        "bin.pdf",
        "empty.csv",
    }
    assert added["sub dir/b.TXT"].ext == ".txt" and added["a.txt"].parse_status == "pending"

    registry = spark.createDataFrame(list(added.values()), report.added.schema)
    put("new.txt", "something")
    again = ingest.ingest_directory(spark, root, "I2", registry)
    assert (again.files_new, again.files_duplicate) == (1, 7)
    assert [r.path_rel for r in again.added.collect()] == ["new.txt"]


def test_large_files_are_streamed_through_their_hash(spark, folder):
    root, put = folder
    put("odd a%20b#c+é.csv", "odd")
    columns = ["path_abs", "size_bytes", "sha256", "detected_type", "ext"]
    results = [
        sorted(map(tuple, report.added.select(*columns).collect()))
        for report in (
            ingest.ingest_directory(spark, root, "I", row_bytes=limit)
            for limit in (source.ROW_BYTES, 100, 0)
        )
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 7


def test_no_file_is_left_out(spark, tmp_path):
    """Names with an underscore or a dot in front, in folders of such names, and empty files."""
    names = ["a.txt", "_b.txt", ".c.txt", "_old/x/d.txt", ".git/e.csv", "_f.exe", "x/_empty.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if "empty" in name else f"{name} {PLAIN}")
    root = str(tmp_path)
    report = ingest.ingest_directory(spark, root, "I")
    assert (report.files_found, report.files_new, report.files_skipped) == (6, 6, 1)
    assert {r.path_rel for r in report.added.collect()} == set(names) - {"_f.exe"}
    streamed = ingest.ingest_directory(spark, root, "I", row_bytes=10)
    shas = [{r.path_rel: r.sha256 for r in x.added.collect()} for x in (report, streamed)]
    assert shas[0] == shas[1]
    first = ingest.ingest_directory(spark, root, "I", max_files=3)
    assert {r.filename for r in first.added.collect()} == {".c.txt", "e.csv", "_b.txt"}
    assert {r.file_id.removeprefix(f"{root}/") for r in source.read_texts(spark, root).collect()} == set(names)
    assert ingest.ingest_directory(spark, f"{root}/_b.txt", "I").files_new == 1


def test_a_file_that_is_gone_does_not_stop_the_others(spark, folder):
    root, _ = folder
    (pathlib.Path(root) / "broken.txt").symlink_to(f"{root}/nowhere.txt")
    report = ingest.ingest_directory(spark, root, "I")
    assert (report.files_error, report.files_new, report.files_duplicate) == (1, 6, 1)
    assert report.notes == "6 new, 1 dup, 1 errors" and report.status == "success"
    assert [r.filename for r in report.errors.collect()] == ["broken.txt"]
    alone = pathlib.Path(root) / "alone"
    alone.mkdir()
    (alone / "x.txt").symlink_to(f"{root}/nowhere.txt")
    assert ingest.ingest_directory(spark, str(alone), "I").status == "failed"


@pytest.fixture(scope="module")
def both_readers(spark, tmp_path_factory):
    """The folder of a parse job, and its report with nearly all files read as lines or as texts."""
    root = tmp_path_factory.mktemp("jobs")
    files = {
        "a.txt": PLAIN,
        "b.TXT": MS,
        "n.txt": NMR,
        "later.txt": PLAIN + "#OTHER_START\nSamples\tq1\tq2\n#END\n",
        "w.txt": PLAIN.replace("ST000001", "ST7").replace("Lactate", "Odd\tabout 3\t2\nLactate"),
        "mark.txt": "\ufeff" + PLAIN.replace("ST000001", "ST8"),
    }
    for name, text in files.items():
        (root / name).write_text(text, encoding="utf-8")
    limits = (100, parse.LARGE_BYTES)
    return str(root), [
        parse.parse_directory(spark, str(root), empty_store(spark), large_bytes=n) for n in limits
    ]


def test_a_byte_order_mark_is_no_text(both_readers):
    _, reports = both_readers
    for done in reports:
        assert (done.files_total, done.files_success) == (6, 6)
        cells = done.changes.parsed.measurements
        assert cells.where("study_id = 'ST8'").count() == cells.where("study_id = 'ST7'").count() - 2


def test_lines_keep_their_numbers_when_splits_change(spark, tmp_path):
    rows = "".join(f"met{i}\t{i}\t{i + 1}\n" for i in range(30_000))
    text = PLAIN.replace("Lactate", rows + "Lactate")
    (tmp_path / "big.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        lines = source.read_lines(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "37000")
        matrices = LineMatrices(lines, mwtab.PLAIN)
        assert matrices.headers.count() == 1
        spark.conf.set("spark.sql.files.maxPartitionBytes", "250000")
        cells = matrices.measurements.where(F.startswith("feature_name", F.lit("met")))
        assert cells.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stream_and_batch_take_the_same_layouts(spark, both_readers):
    root, reports = both_readers
    texts = source.read_texts(spark, root)
    layout = mwtab.layout_by_markers(F.col("content")).alias("layout")
    wanted = {r.file_id: r.layout for r in texts.select("file_id", layout).collect()}
    assert {pathlib.Path(f).name: x for f, x in wanted.items()} == {
        "a.txt": "mwtab",
        "later.txt": "mwtab",
        "w.txt": "mwtab",
        "mark.txt": "mwtab",
        "b.TXT": "mwtab_ms",
        "n.txt": "mwtab_nmr_binned",
    }
    lines = source.types_of_lines(source.read_lines(spark, root)).collect()
    assert {r.file_id: r.layout for r in lines} == wanted
    for done in reports:
        cells = done.changes.parsed.measurements.select("file_id", "layout").distinct().collect()
        assert {r.file_id: r.layout for r in cells} == wanted
        names = {r.name_raw for r in done.changes.new_features.collect()}
        assert not {n for n in names if n.lower() == "factors"}


def test_warnings_of_jobs(both_readers):
    _, reports = both_readers
    found = []
    for done in reports:
        rows = done.warnings.where(F.endswith("file_id", F.lit("w.txt")))
        found.append(sorted((r.kind, r.text) for r in rows.collect()))
        assert done.warnings_count == done.warnings.count()
    assert found[0] == found[1] and ("unreadable_value", "about 3") in found[0]


def test_an_empty_stored_name_is_filled(spark, folder):
    root, _ = folder
    store = empty_store(spark)
    first = parse.parse_directory(spark, root, store).changes
    features = first.new_features.withColumn("name_raw", F.lit("").cast("string"))
    features = spark.createDataFrame(features.collect(), features.schema)
    again = parse.parse_directory(spark, root, store | {"features": features}).changes
    filled = {r.feature_uid: r.name_raw for r in again.filled_features.collect()}
    plain = {r.feature_uid: r.name_raw for r in again.parsed.plain("features").collect()}
    assert filled == plain and filled
    assert again.new_features.count() == 0


def test_ingest_options(spark, folder):
    root, _ = folder
    only = ingest.ingest_directory(spark, root, "I", extensions=["TXT", "exe"])
    assert (only.files_found, only.files_processed, only.files_skipped) == (5, 4, 4 + 1)
    first = ingest.ingest_directory(spark, root, "I", max_files=2)
    assert {r.path_rel for r in first.added.collect()} == {"a.txt", "bin.pdf"}
    dry = ingest.ingest_directory(spark, root, "I", dry_run=True)
    assert dry.files_found == 7 and dry.added is None
    one = ingest.ingest_directory(spark, f"{root}/a.txt", "I")
    assert one.files_new == 1 and one.by_type == {"mwtab": 1}


def test_outcome_notes(spark):
    df = spark.createDataFrame([(0, 1, 2), (3, 1, 2), (3, 1, 0)], "files_new int, files_duplicate int, e int")
    got = [(r.status, r.notes) for r in ingest.with_outcome(df, errors="e").collect()]
    assert got == [
        ("failed", "0 new, 1 dup, 2 errors"),
        ("success", "3 new, 1 dup, 2 errors"),
        ("success", "3 new, 1 duplicates"),
    ]


def test_import_log(spark):
    log = (
        ingest.import_event(spark, "I", 1, root_path="/r")
        .unionByName(ingest.import_event(spark, "I", 2, "running", notes="n"))
        .unionByName(ingest.import_event(spark, "I", 3, "success"))
    )
    assert tuple(ingest.current_imports(log).first()) == ("I", "/r", "success", "n")
    with pytest.raises(ValueError):
        ingest.import_event(spark, "I", 4, "done")


def test_parse_directory(spark, folder):
    root, put = folder
    put("broken.txt", "#METABOLOMICS WORKBENCH\nVERSION\t1\n")
    store = empty_store(spark)
    dry = parse.parse_directory(spark, root, store, dry_run=True)
    assert (dry.files_total, dry.by_type) == (4, {"mwtab": 4})
    done = parse.parse_directory(spark, root, store)
    assert (done.files_total, done.files_success, done.files_failed) == (4, 3, 1)
    assert done.by_type == {"mwtab": 3} and done.measurements_inserted > 0
    none = parse.parse_directory(spark, root, store, skip_types={"mwtab"})
    assert (none.files_total, none.files_skipped) == (0, 4)
    with pytest.raises(RuntimeError, match="broken"):
        parse.parse_directory(spark, root, store, fail_fast=True)


def test_large_files_are_parsed_as_lines(spark, folder):
    root, put = folder
    put("large.txt", PLAIN.replace("ST000001", "ST9").replace("Lactate", "x\t1\t2\n" * 400 + "Lactate"))
    put("large_res.txt", PLAIN * 20)
    store = empty_store(spark)
    results = []
    for limit in (1000, parse.LARGE_BYTES):
        done = parse.parse_directory(spark, root, store, large_bytes=limit)
        states = done.changes.updated_measurements, done.changes.samples
        rows = [r for df in states for r in df.drop("created_at").collect()]
        features = done.changes.new_features.select("feature_uid", "name_raw").collect()
        results.append((done.files_total, done.files_success, sorted(map(str, rows + features))))
    assert results[0] == results[1] and results[0][0] == 4


def test_ingest_then_parse_import(spark, folder):
    """The whole way; a second run over the settled registry has nothing to do."""
    root, _ = folder
    report = ingest.ingest_directory(spark, root, "I1")
    registry = report.added
    assert set(registry.columns) == {f.name for f in schemas.FILES}
    texts = source.read_texts(spark, root).withColumnRenamed("file_id", "path_abs")
    texts = texts.join(registry.select("path_abs", "file_id"), "path_abs").drop("path_abs")
    store = empty_store(spark)
    done = parse.parse_import(spark, registry, texts, "I1", store)
    assert (done.files_total, done.files_success, done.files_skipped) == (6, 2, 4)
    after = parse.with_status(registry, done.outcomes, datetime.datetime(2024, 6, 1))
    states = {r.filename: r.parse_status for r in after.collect()}
    assert states["a.txt"] == "success" and states["bin.pdf"] == "skipped"
    again = parse.parse_import(spark, after, texts, "I1", store)
    assert again.files_total == 0 and again.measurements_inserted == 0


def test_incremental_ingest(spark, tmp_path):
    inbox, table, log = (str(tmp_path / n) for n in ("inbox", "table", "log"))
    (tmp_path / "inbox").mkdir()
    for name, text in (("p.txt", PLAIN), ("m.txt", MS), ("other.txt", HEAD)):
        (tmp_path / "inbox" / name).write_text(text)

    def run():
        return incremental.ingest_available(spark, inbox, table, log).groupBy("layout").count()

    first = {r.layout: r["count"] for r in run().collect()}
    assert first == {"mwtab": 4, "mwtab_ms": 9}
    assert {r.layout: r["count"] for r in run().collect()} == first
    (tmp_path / "inbox" / "n.txt").write_text(NMR)
    assert {r.layout: r["count"] for r in run().collect()} == first | {"mwtab_nmr_binned": 3}


def test_incremental_ingest_takes_hidden_files_once(spark, tmp_path):
    inbox, table, log = (str(tmp_path / n) for n in ("inbox", "table", "log"))

    def put(name, text):
        file = tmp_path / "inbox" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)

    def run():
        rows = incremental.ingest_available(spark, inbox, table, log).groupBy("file_id").count()
        return {r.file_id.removeprefix(f"{inbox}/"): r["count"] for r in rows.collect()}

    put("p.txt", PLAIN)
    assert run() == {"p.txt": 4}
    for name in ("_p.txt", ".dir/m.txt", "_dir/deep/p.txt", "_k=v/p.txt"):
        put(name, MS if name.endswith("m.txt") else PLAIN)
    (tmp_path / "inbox" / ".gone").symlink_to(tmp_path / "nowhere")
    wanted = {"p.txt": 4, "_p.txt": 4, ".dir/m.txt": 9, "_dir/deep/p.txt": 4, "_k=v/p.txt": 4}
    assert run() == wanted
    assert run() == wanted
    put(".n.txt", NMR)
    assert run() == wanted | {".n.txt": 3}


def star_tables(spark):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 600, tzinfo=datetime.timezone.utc)
    make = spark.createDataFrame
    return {
        "measurements": make(
            [
                (f"s{i % 3}", f"f{i % 4}", float(i), "u", "F1" if i % 2 else None, i, 1, at)
                for i in range(24)
            ],
            "sample_uid string, feature_uid string, value double, unit string, file_id string, "
            "col_index int, replicate_ix int, created_at timestamp",
        ),
        "files": make(
            [("F1", "I1", "p", "mwtab", "GCMS", "OB", "Serum", "QQQ")],
            "file_id string, import_id string, path_rel string, detected_type string, "
            "device string, exposure string, sample_type string, platform string",
        ),
        "samples": make([("s0", "1", "S0"), ("s1", "2", "S1")], "sample_uid string, study_pk string, sample_label string"),
        "features": make(
            [("f0", "metabolite", "n0", None, "A"), ("f1", "nmr_bin", "n1", "r", "A")],
            "feature_uid string, feature_type string, name_raw string, refmet_name string, analysis_id string",
        ),
        "studies": make([("1", "ST1"), ("2", "ST2")], "study_pk string, study_id string"),
        "analyses": make([("1", "A")], "study_pk string, analysis_id string"),
    }


def test_export_sink(spark, tmp_path):
    t = star_tables(spark)
    rows = export.in_export_order(export.export_long(t))
    stats = tables.write_export(rows, str(tmp_path / "out"), chunk_rows=5)
    assert stats.total_rows == 24 and stats.total_chunks >= 5 and stats.file_size_bytes > 0
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 24 and dict(back.dtypes)["col_index"] == "double"
    assert back.first().created_at == "2024-01-02 03:04:05.000600+00:00"
    import pyarrow.parquet as pq

    part = next((tmp_path / "out").glob("part-*.parquet"))
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"
    none = tables.write_export(export.export_long(t, study_id="no"), str(tmp_path / "none"))
    assert none == tables.ExportStats(str(tmp_path / "none")) and not (tmp_path / "none").exists()


def test_an_export_is_read_back_by_its_statistics(spark, tmp_path):
    """Files in the order of the columns to find by: readers skip row groups, and know by Bloom
    filters which files lack a value."""
    import pyarrow.parquet as pq

    rows = spark.range(100_000).select(
        F.format_string("d%02d", F.pmod(F.xxhash64("id"), F.lit(40))).alias("device"),
        F.format_string("s%d", "id").alias("sample_uid"),
        F.col("id").cast("double").alias("value"),
    )
    path = str(tmp_path / "out")
    stats = tables.write_export(rows.coalesce(1), path, chunk_rows=1_000_000, find_by=["device", "sample_uid"])
    assert stats.total_rows == 100_000 and stats.total_chunks == 1
    meta = pq.ParquetFile(next((tmp_path / "out").glob("part-*.parquet"))).metadata
    assert meta.num_row_groups >= 5
    hit = [
        meta.row_group(i).column(0).statistics
        for i in range(meta.num_row_groups)
        if meta.row_group(i).column(0).statistics.min <= "d07" <= meta.row_group(i).column(0).statistics.max
    ]
    assert len(hit) <= 2
    found = spark.read.parquet(path).where("device = 'd07'")
    assert "EqualTo(device,d07)" in found._jdf.queryExecution().executedPlan().toString()
    wanted = rows.where("device = 'd07'")
    assert found.count() == wanted.count()


def test_qc_scans_the_facts_once(spark, tmp_path):
    t = star_tables(spark)
    t["samples"] = t["samples"].withColumn("factors_raw", F.lit(None).cast("string"))
    for name in ("measurements", "samples", "features"):
        t[name].write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    report = qc.summary(t["measurements"], t["samples"], t["features"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("feature_uid:string,value:double>") == 1  # what the scan of the facts reads
    assert {str(f.dataType) for f in report.schema if f.name != "null_percent"} == {"LongType()"}
    row = report.first()
    assert (row.total_measurements, row.duplicate_pairs_count) == (24, 12)
    assert (row.orphan_sample_count, row.orphan_feature_count, row.samples_total) == (1, 2, 2)


def test_replicates_of_a_wide_header_are_numbered_in_linear_time(spark):
    import time

    from assayframe.operators.mwtab import places_of

    wide = [f"S{i}" for i in range(20_000)]
    wide[17_000] = wide[5]
    rows = [(0, ["b", "a", "b", None, "a", "b", None]), (1, wide), (2, [])]
    df = spark.createDataFrame(rows, "id int, labels array<string>")
    start = time.perf_counter()
    found = {r["id"]: r["p"] for r in df.select("id", places_of(F.col("labels")).alias("p")).collect()}
    assert time.perf_counter() - start < 20
    assert [(p["nth"], p["last"]) for p in found[0]] == [
        (1, False), (1, False), (2, False), (1, False), (2, True), (3, True), (2, True)
    ]
    assert [p["at"] for p in found[1]] == list(range(20_000))
    assert found[1][17_000]["nth"] == 2 and not found[1][5]["last"] and found[2] == []


def test_lines_by_byte_ranges(spark, tmp_path):
    """Whatever the ranges, the same lines under the same numbers; hidden files are read, too."""
    import random

    draw = random.Random(3)
    ends = ["\n", "\r\n", "\r"]
    for name in ("a.txt", "_b.txt", ".dir/c.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        lines = ["é" * draw.randrange(9) + draw.choice(ends) for _ in range(60)] + ["last"]
        path.write_bytes("".join(lines).encode())
    (tmp_path / "empty.txt").write_text("")

    def lines(range_bytes):
        found = source.read_lines(spark, str(tmp_path), range_bytes=range_bytes)
        return sorted((r.file_id, r.no.offset, r.text) for r in found.collect())

    whole = lines(1 << 20)
    for name in ("a.txt", "_b.txt", ".dir/c.txt"):
        text = (tmp_path / name).read_bytes().decode()
        plain = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        assert [t for f, _, t in whole if f == str(tmp_path / name)] == plain
    assert len({(f, o) for f, o, _ in whole}) == len(whole)
    for size in (1, 2, 7, 50):
        assert lines(size) == whole


def test_small_chunks_of_a_range_give_the_same_lines(monkeypatch):
    import io

    data = b"one\r\ntwo\rthree\n\n\r\nfour five six\r\n"
    whole = [x for part in source._lines_of(io.BytesIO(data), 0, len(data)) for x in zip(*part, strict=True)]
    for chunk in range(1, 12):
        monkeypatch.setattr(source, "STREAM_CHUNK", chunk)
        for size in (1, 3, 10, 100):
            found = []
            for start in range(0, len(data), size):
                for part in source._lines_of(io.BytesIO(data), start, min(len(data), start + size)):
                    found += zip(*part, strict=True)
            assert found == whole


def test_a_deep_tree_is_listed_by_many_tasks(spark, tmp_path, monkeypatch):
    """One root folder with all the rest below: every level is spread over tasks."""
    for i in range(12):
        for j in range(3):
            folder = tmp_path / "only" / f"a{i}" / f"b{j}"
            folder.mkdir(parents=True)
            (folder / "x.txt").write_text("x")
    levels = []
    settle = source.settle
    monkeypatch.setattr(source, "settle", lambda df, p: levels.append(df.rdd.getNumPartitions()) or settle(df, p))
    found = source.listing(spark, str(tmp_path)).collect()
    assert len(found) == 36 and len(levels) == 4
    assert levels[0] == 1 and min(levels[1:]) > 1


def test_export_count_is_export(spark):
    t = star_tables(spark)
    for filters in (
        {},
        {"file_id": "F1"},
        {"import_id": "I1", "study_id": "ST2"},
        {"feature_type": "nmr_bin"},
        {"study_id": "it's"},
    ):
        n = export.export_long(t, **filters).count()
        assert export.export_count(t, **filters).first().row_count == n


def test_export_joins_what_is_asked_for(spark):
    t = star_tables(spark)
    whole = export.export_long(t)
    for columns in (["value"], ["device", "value"], ["study_id"], ["analysis_id", "unit"]):
        part = export.export_long(t, columns)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.select(columns).collect()))
    plan = export.export_long(t, ["value", "unit"])._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString()
    plan = export.export_long(t, ["value"], study_id="ST1")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Join") == 2


def test_settings_follow_the_input():
    from assayframe.session import settings_for

    big = settings_for(100 * 10**12, 8000)
    assert 350_000 < int(big["spark.sql.shuffle.partitions"]) < 400_000
    small = settings_for(10**9, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert int(small["spark.sql.files.maxPartitionBytes"]) < 50_000_000


def test_long_view_is_a_view(spark):
    t = star_tables(spark)
    t["measurements"] = t["measurements"].withColumn("measurement_id", F.lit("m"))
    t["samples"] = t["samples"].withColumns({"exposure": F.lit("OB"), "sample_matrix": F.lit("Urine")})
    t["files"] = t["files"].withColumn("filename", F.lit("x.txt"))
    export.register_long_view(t)
    found = spark.sql("SELECT exposure, device, count(*) n FROM v_long_measurements GROUP BY ALL")
    assert {tuple(r) for r in found.collect()} == {
        ("OB", None, 8),
        ("OB", "GCMS", 8),
        (None, None, 4),
        (None, "GCMS", 4),
    }


def test_filter_becomes_inner_join_and_prunes(spark, tmp_path):
    t = star_tables(spark)
    for name, df in t.items():
        df.write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in t}
    plan = export.export_long(t, study_id="ST1").select("value")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(study_id), EqualTo(study_id,ST1)" in text
    assert "LeftSemi" in text and "LeftOuter" in text and "Inner" not in text
    assert "ReadSchema: struct<study_pk:string,study_id:string>" in text


def joins_above(plan, scan):
    """Types of the joins above a scan, nearest first, in an optimized plan."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, out = lines[at].find("+- ") if "+- " in lines[at] else lines[at].find(":- "), []
    for line in reversed(lines[:at]):
        own = max(line.find("+- "), line.find(":- "))
        if own < depth:
            depth = own
            if "Join " in line:
                out.append(line.split("Join ")[1].split(",")[0].split(" ")[0])
    return out


def test_facts_are_reduced_before_they_meet_the_star(spark, tmp_path):
    t = star_tables(spark)
    for name, df in t.items():
        df.write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in t}
    filters = {"study_id": "ST1", "feature_type": "metabolite", "import_id": "I1"}
    plan = export.export_long(t, **filters)._jdf.queryExecution().optimizedPlan().toString()
    above = joins_above(plan, "Relation [sample_uid")
    assert above[:3] == ["LeftSemi"] * 3 and set(above[3:]) == {"LeftOuter"} and len(above) == 8
    every = export.filtered(export.star(**t), **filters)
    columns = export.export_columns(every)
    assert sorted(map(str, columns.collect())) == sorted(map(str, export.export_long(t, **filters).collect()))


def test_empty_report(spark):
    t = star_tables(spark)
    samples = t["samples"].withColumn("factors_raw", F.lit(None).cast("string"))
    report = qc.summary(t["measurements"].limit(0), samples, t["features"])
    got = {r.metric: (r.value, r.status) for r in qc.graded(report).collect()}
    assert got["total_measurements"] == (0, "EMPTY") and got["null_count"] == (0, "OK")
    assert got["samples_no_factors"] == (2, "WARN")
    assert qc.issues(report).count() == 0


def test_tag_selection(spark):
    files = spark.createDataFrame([("a", "I")], "file_id string, import_id string")
    with pytest.raises(ValueError):
        tagging.select_files(files)
    assert tagging.select_files(files, import_id="I").count() == 1
    assert tagging.select_files(files, file_id="b", everything=True).count() == 0


def test_shared_folder_comes_from_the_session():
    class Conf(dict):
        def get(self, key, default):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.checkpoint.dir": "/shared/place/"})

        class sparkContext:
            master = "yarn"

    assert shared_folder(Session, "x").startswith("/shared/place/x-")
    Session.conf = Conf()
    with pytest.raises(ValueError):
        shared_folder(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert "x-" in shared_folder(Session, "x")


def test_rewrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    batch = spark.createDataFrame([(3, "b")], "v int, p string")
    touched = tables.touched_partitions(spark.read.parquet(path), batch, ["p"])
    assert [r.v for r in touched.collect()] == [2]
    tables.rewrite_partitions(batch, path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_parse_selection(spark):
    df = spark.createDataFrame(
        [("a", "mwtab"), ("b", "mwtab_ms"), ("c", "unknown")], "file_id string, detected_type string"
    )
    chosen = parse.parsable_files(df, only_types={"mwtab"})
    assert {(r.file_id, r.selected) for r in chosen.collect()} == {("a", True), ("b", False)}
