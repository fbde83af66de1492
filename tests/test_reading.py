"""Whole files read in tasks, from the listing."""

import datetime
import hashlib

import pytest

from assayframe.plans import ingest, load, parse
from assayframe.sources import files as source
from assayframe.sources.store import Store
from tests.test_mwtab import MS, NMR, PLAIN

AT = datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)


@pytest.fixture
def inbox(tmp_path):
    for i in range(40):
        folder = tmp_path / "in" / f"d{i % 5}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f {i}.txt").write_bytes(f"content {i % 30}".encode())
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    (tmp_path / "in" / "_hidden.txt").write_bytes(b"hidden")
    return tmp_path / "in"


def under(df, root) -> list[str]:
    """Files below a folder that the driver has a list of."""
    return [path for path in df.inputFiles() if str(root) in path.replace("%20", " ")]


def test_driver_has_no_list_of_files_for_texts(spark, inbox):
    texts = source.read_texts(spark, str(inbox))
    assert not under(texts, inbox)
    wanted = {str(p): p.read_text() for p in inbox.rglob("*.txt")}
    assert {r.file_id: r.content for r in texts.collect()} == wanted


def test_driver_has_no_list_of_files_at_ingest(spark, inbox, monkeypatch):
    read, seen = source.read_files, []
    monkeypatch.setattr(source, "read_files", lambda *a, **k: seen.append(read(*a, **k)) or seen[-1])
    report = ingest.ingest_directory(spark, str(inbox), "I1")
    assert len(seen) == 1 and not under(seen[0], inbox)
    assert (report.files_found, report.files_processed, report.files_error) == (42, 42, 0)
    digests = {hashlib.sha256(p.read_bytes()).hexdigest() for p in inbox.rglob("*.txt")}
    assert {r.sha256 for r in report.added.collect()} == digests and report.files_new == 32


def test_only_listed_files_are_read(spark, inbox):
    listed = source.listing(spark, str(inbox)).where("path LIKE '%/d1/%'")
    got = {r.path_abs for r in source.read_files(spark, str(inbox), listed=listed).collect()}
    assert got == {str(p) for p in (inbox / "d1").iterdir()}


def test_rows_are_sent_in_chunks_and_large_files_alone(spark, inbox, monkeypatch):
    import pyarrow as pa

    paths = sorted(str(p) for p in inbox.rglob("f*.txt"))
    monkeypatch.setattr(source, "STREAM_CHUNK", 25)
    (inbox / "large.txt").write_bytes(b"x" * 60)
    some = [*paths[:5], str(inbox / "gone.txt"), str(inbox / "large.txt"), *paths[5:]]
    batches = list(source._read_bytes(iter([pa.RecordBatch.from_arrays([pa.array(some)], names=["path"])])))
    got = [(r["path"], r["content"]) for b in batches for r in b.to_pylist()]
    assert got == [(p, open(p, "rb").read()) for p in some if "gone" not in p]
    assert [b.num_rows for b in batches if b.column("content")[0].as_py() == b"x" * 60] == [1]
    assert max(b.num_rows for b in batches) == 2
    monkeypatch.setattr(source, "MOST_IN_ROW", 50)
    with pytest.raises(ValueError, match="large.txt has 60 bytes"):
        list(source._read_bytes(iter([pa.RecordBatch.from_arrays([pa.array(some)], names=["path"])])))


def broadcasts(df) -> list[str]:
    """What the plan of a table broadcasts: the lines of each such part."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            found.append("\n".join(lines[i:end]))
    return found


def loaded(spark, tmp_path, monkeypatch, texts, batch):
    """Files of an import loaded into a new store: its counts, cells, and the table of texts."""
    inbox = tmp_path / "in"
    for name, text in (("a", PLAIN), ("copy of a", PLAIN), ("_b", MS), ("c", NMR), ("note", "x")):
        inbox.mkdir(exist_ok=True)
        (inbox / f"{name}.txt").write_text(text)
    seen, routed = [], parse.routed
    monkeypatch.setattr(parse, "routed", lambda files, *a: seen.append(files) or routed(files, *a))
    store = Store.create(spark, str(tmp_path / batch), groups=4, inside=1)
    load.ingest_into(store, str(inbox), "I1", created_at=AT)
    done = load.parse_pending(store, texts(str(inbox)), "I1", "parse I1", created_at=AT)
    cells = store.read("measurements").select("sample_uid", "feature_uid", "value", "file_id").collect()
    return done, sorted(map(str, cells)), seen[0]


def test_texts_are_read_by_id_and_meet_no_join(spark, tmp_path, monkeypatch):
    by_id = lambda root: lambda due: source.read_texts(spark, listed=due)
    joined = lambda root: source.read_texts(spark, root).withColumnRenamed("file_id", "path_abs")
    done, cells, files = loaded(spark, tmp_path, monkeypatch, by_id, "by-id")
    again, same, met = loaded(spark, tmp_path, monkeypatch, joined, "joined")
    done.commit = again.commit = None
    assert done == again and cells == same and cells
    assert (done.files_total, done.files_skipped) == (4, 1)
    # copies are not read again, and no text is shuffled or broadcast
    assert files.count() == 4 and "Join" not in files._jdf.queryExecution().executedPlan().toString()
    assert met.count() == 4 and not [b for b in broadcasts(met) if "MapInArrow" in b]


def test_texts_of_many_files_are_not_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parse, "BROADCAST_FILES", 2)
    joined = lambda root: source.read_texts(spark, root).withColumnRenamed("file_id", "path_abs")
    done, cells, met = loaded(spark, tmp_path, monkeypatch, joined, "joined")
    assert done.files_total == 4 and cells
    assert met.count() == 4 and not broadcasts(met)
