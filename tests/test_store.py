"""The bucketed store: what a batch reads and writes, crashes, replays, and the jobs on top of it."""

import datetime
import pathlib
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from assayframe import schemas
from assayframe.operators import export
from assayframe.plans import load, parse
from assayframe.sources import files as source
from assayframe.sources.store import Store
from assayframe.streaming import incremental
from bindings.matrices import empty_store
from tests.test_mwtab import MS, NMR, PLAIN

AT = datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)
TABLES = ("studies", "analyses", "samples", "features", "measurements")
VALUES = ["sample_uid", "feature_uid", "value", "unit", "file_id", "col_index", "replicate_ix"]


@pytest.fixture
def store(spark, tmp_path):
    return Store.create(spark, str(tmp_path / "store"), groups=8, inside=2)


def parsed_of(spark, files):
    """files: name -> text"""
    df = spark.createDataFrame(sorted(files.items()), "file_id string, content string")
    layout = parse.mwtab.layout_by_markers(F.col("content"))
    df = df.withColumn("layout", layout).withColumn("detected_type", F.coalesce("layout", F.lit("unknown")))
    return df, parse.Parsed(parse.routed(df).where("layout IS NOT NULL"), "layout")


def load_files(spark, store, files, batch):
    return load.load(store, *parsed_of(spark, files), batch, created_at=AT)


def study(text, number):
    """The same file under other study and analysis ids."""
    for old, new in (("ST", f"ST9{number}"), ("AN", f"AN9{number}")):
        text = text.replace(f"_ID:{old}", f"_ID:{new}")
    return text


def rows(df, columns=VALUES):
    return sorted(map(str, df.select(*columns).collect()))


def batches():
    """Files of all layouts in two batches that repeat, fill and update each other's rows."""
    return [
        {"a": PLAIN, "b": MS, **{f"m{i}": study(MS, i) for i in range(6)}},
        {
            "c": NMR,
            "d": PLAIN.replace("\t2", "\t22"),
            "m0": study(MS, 0).replace("\t1", "\t7"),
            "e": study(PLAIN, 1),
            "f": MS.replace("\t3", "\t33"),
            "x": "no table",
        },
    ]


def whole_tables(spark, given):
    """The same batches merged with the whole tables in memory."""
    tables = empty_store(spark)
    for files in given:
        change = parse.Changes(parsed_of(spark, files)[1], tables, AT)
        states = {
            "studies": tables["studies"].unionByName(change.new_studies),
            "analyses": change.analyses,
            "samples": change.samples,
            "features": tables["features"].unionByName(change.new_features),
            "measurements": change.updated_measurements,
        }
        states = {name: schemas.conform(df, schemas.SHAPES[name]) for name, df in states.items()}
        tables = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in states.items()}
    return tables


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """A store with the first batch, and the counts of that load."""
    root = str(tmp_path_factory.mktemp("base") / "store")
    store = Store.create(spark, root, groups=8, inside=2)
    return root, load_files(spark, store, batches()[0], "first")


@pytest.fixture
def loaded(spark, base, tmp_path):
    """A copy of it: all paths of a store are relative."""
    shutil.copytree(base[0], tmp_path / "loaded")
    return Store(spark, str(tmp_path / "loaded"))


class Died(Exception):
    pass


def die(*_):
    raise Died


def all_rows(store):
    return {name: rows(store.read(name), [f.name for f in schemas.SHAPES[name]]) for name in TABLES}


def test_batches_give_what_whole_tables_give(spark, base, loaded, monkeypatch):
    """Also where a job dies before its commit and runs again, and where it runs once more."""
    first, second = batches()
    before = all_rows(loaded)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", die)
        with pytest.raises(Died):
            load_files(spark, loaded, second, "second")
    assert all_rows(loaded) == before
    created = [base[1], load_files(spark, loaded, second, "second")]
    wanted = whole_tables(spark, [first, second])
    for name, df in wanted.items():
        assert rows(loaded.read(name), [f.name for f in schemas.SHAPES[name]]) == rows(
            df, [f.name for f in schemas.SHAPES[name]]
        ), name
    assert sum(s.measurements_inserted for s in created) == wanted["measurements"].count()
    assert sum(s.samples_created for s in created) == wanted["samples"].count()
    assert sum(s.features_created for s in created) == wanted["features"].count()
    assert created[1].files_total == len(second) and created[1].files_skipped == 1
    assert created[1].by_type == {"mwtab": 2, "mwtab_ms": 2, "mwtab_nmr_binned": 1}
    assert load_files(spark, loaded, second, "second").commit is None


def broken_outside(store, near):
    """Destroy the files of all buckets but ``near``."""
    broken = 0
    for table, buckets in near.items():
        for s in store.segments(table):
            if s.bucket not in buckets:
                for part in pathlib.Path(store.root, s.folder, f"bucket={s.bucket}").glob("part-*"):
                    part.write_bytes(b"no parquet")
                    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
                    broken += 1
    return broken


def test_a_batch_reads_and_writes_its_buckets_alone(spark, loaded):
    """Files of other buckets are destroyed, and the batch does not notice."""
    files = {"n": study(PLAIN, 3), "o": study(MS, 3).replace("Samples\t", "Samples\tNEW\t")}
    near = load.touched(loaded, parsed_of(spark, files)[1])
    before = loaded.segments("measurements")
    held = {s.bucket for s in before}
    assert set(near["measurements"]) & held and held - set(near["measurements"])
    paths = loaded.read("measurements", near["measurements"]).inputFiles()
    assert paths and all(int(p.split("bucket=")[1].split("/")[0]) in near["measurements"] for p in paths)
    assert broken_outside(loaded, near)
    done = load_files(spark, loaded, files, "second")
    assert done.commit == 2 and done.measurements_inserted > 0
    new = set(loaded.segments("measurements")) - set(before)
    assert new and {s.bucket for s in new} <= set(near["measurements"])


def test_texts_are_scanned_once(spark, tmp_path, monkeypatch):
    """The source is read by one job; layouts read their own folders of what that wrote."""
    import assayframe.plans.parse as module

    source_path = str(tmp_path / "texts")
    df = parsed_of(spark, batches()[0])[0].drop("layout")
    df.write.parquet(source_path)
    texts = parse.with_layout(spark.read.parquet(source_path), F.col("content"))
    files = module.routed(texts)
    parsed = parse.Parsed(files.where("layout IS NOT NULL"), "layout")
    for name in ("metadata", "samples", "features", "measurements"):
        paths = getattr(parsed, name).inputFiles()
        assert paths and all("/layout=" in p and source_path not in p for p in paths)
    empty = files.where("layout IS NULL AND content IS NOT NULL")
    assert empty.isEmpty() and files.count() == len(batches()[0])


def test_known_rows_write_nothing(spark, loaded):
    was = {name: loaded.segments(name) for name in TABLES}
    load_files(spark, loaded, {"m0": study(MS, 0)}, "again")
    assert {name: loaded.segments(name) for name in TABLES} == was


def test_segments_replace_append_and_compact(spark, store):
    def row(i, value, sample="ST1:a"):
        return (sample, f"AN1:met:{i}", float(value))

    def put_rows(given, replaces=False, batch="x"):
        df = spark.createDataFrame(given, "sample_uid string, feature_uid string, value double")
        segments, n = store.write("measurements", df, replaces=replaces)
        assert n == len(given)
        store.commit(segments, batch)

    def values():
        return sorted((r.feature_uid, r.value) for r in store.read("measurements").collect())

    assert store.write("measurements", store.read("measurements")) == ([], 0)
    put_rows([row(1, 1)])
    put_rows([row(2, 2)])
    put_rows([row(3, 3, "ST2:b")])
    put_rows([row(1, 9), row(4, 4)], replaces=True)  # takes the place of ST1:a's bucket
    put_rows([row(5, 5)])
    was = values()
    assert was == [(f"AN1:met:{i}", float(v)) for i, v in ((1, 9), (3, 3), (4, 4), (5, 5))]
    assert store.compact("measurements", most=1) == 1 and store.compact("measurements", most=1) == 0
    assert values() == was and not store.has("y")


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_a_stream_that_dies_between_write_and_commit(spark, store, tmp_path, monkeypatch):
    inbox, log = tmp_path / "inbox", str(tmp_path / "log")
    files = {"a": PLAIN, "b": MS, "c": study(MS, 1)}
    for name, text in files.items():
        put(inbox, f"{name}.txt", text)

    def run():
        texts = incremental.stream_texts(spark, str(inbox), max_files=2)
        incremental.merge_available(texts, store, log, "inbox", AT).awaitTermination()

    real, calls = Store.commit, []

    def second_dies(self, segments, batch):
        calls.append(batch)
        if len(calls) == 2:
            raise Died
        return real(self, segments, batch)

    columns = ["sample_uid", "feature_uid", "value"]
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", second_dies)
        with pytest.raises(StreamingQueryException):
            run()
    assert calls == ["inbox 0", "inbox 1"] and store.has("inbox 0") and not store.has("inbox 1")
    run()
    wanted = rows(whole_tables(spark, [files])["measurements"], columns)
    assert store.has("inbox 1") and rows(store.read("measurements"), columns) == wanted
    # a job that died behind the commit: Spark replays the batch, and the store knows it
    last = sorted((pathlib.Path(log) / "commits").glob("[0-9]*"))[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert rows(store.read("measurements"), columns) == wanted


def test_ingest_meets_its_part_of_the_registry(spark, store, tmp_path):
    inbox = tmp_path / "in"
    for i in range(20):
        put(inbox, f"f{i}.txt", f"content {i}")
    report = load.ingest_into(store, str(inbox), "I1", created_at=AT)
    assert (report.files_new, report.files_duplicate) == (20, 0)
    assert load.ingest_into(store, str(inbox), "I1").status == "known"
    more = tmp_path / "more"
    put(more, "new.txt", "another content")
    put(more, "old.txt", "content 7")
    prints = source.with_fingerprint(source.read_files(spark, str(more)))
    assert broken_outside(store, {"files": store.buckets_of("files", prints)})
    report = load.ingest_into(store, str(more), "I2", created_at=AT)
    assert (report.files_new, report.files_duplicate) == (1, 1)
    assert store.read("imports").count() == 2


def test_jobs_fit_each_other_up_to_an_export(spark, store, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "obese/serum GCMS/a.txt", PLAIN)
    put(inbox, "_b_ms.txt", study(MS, 2))
    put(inbox, "copy.txt", study(MS, 2))
    limit = len(study(MS, 2)) - 1
    assert len(PLAIN) < limit
    put(inbox, "note.txt", "nothing to parse")
    load.ingest_into(store, str(inbox), "I1", created_at=AT)
    # one of the files is hidden and read line by line
    texts = source.read_texts(spark, str(inbox), up_to_bytes=limit).withColumnRenamed("file_id", "path_abs")
    done = load.parse_pending(store, texts, "I1", "parse I1", created_at=AT, large_bytes=limit)
    assert (done.files_total, done.files_success, done.files_skipped) == (3, 2, 1)
    status = {r.filename: r.parse_status for r in store.read("files").collect()}
    assert status == {"a.txt": "success", "_b_ms.txt": "success", "note.txt": "skipped"}
    again = load.parse_pending(store, texts, "I1", "parse I1 again", created_at=AT)
    assert again.files_total == 0 and again.measurements_inserted == 0
    exported = export.export_long(store.tables(*export.NEEDS, "measurements"))
    got = exported.collect()
    assert len(got) == done.measurements_inserted
    strict = [r for r in got if r["path_rel"] == "_b_ms.txt"]
    assert strict and all(r["file_id"] and r["analysis_id"] and r["created_at"] for r in strict)
