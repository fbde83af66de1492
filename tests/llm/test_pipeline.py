"""The pipeline, stage by stage, against what each stage promises."""

import hashlib
import re

import pytest

import corpus_pipeline as cp
from assayframe.llm import common, fertility
from tests.llm.test_mix import WORD, plain_targets
from tests.llm.test_near import plain_classes
from tests.llm.test_private import plain_base


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What goes into each stage and, last, what comes out of the last one."""
    folder = tmp_path_factory.mktemp("stages")
    tables = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for number, (_, stage) in enumerate(cp.STAGES):
        stage(spark, tables[-1], sf_dir).write.parquet(f"{folder}/{number}")
        tables.append(spark.read.parquet(f"{folder}/{number}"))
    return tables


def test_columns(stages):
    for table in stages[:-1]:
        assert table.dtypes == stages[0].dtypes


def test_quality(stages):
    kept = {r["doc_id"] for r in fertility.rules(stages[0]).collect() if r["kept"]}
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted(kept)
    assert 100 < len(kept) < stages[0].count()


def test_near_duplicates(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    firsts = {c for _, c, _ in plain_classes(rows)}
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(firsts)
    assert len(firsts) < len(rows)


def test_personal_data(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    masks = re.compile(r"\[(EMAIL|IP|CARD|PHONE)\]")
    after = stages[3].collect()
    assert {r["doc_id"] for r in after} == set(before)
    for r in after:
        assert not plain_base(r["text"]) and r["n_chars"] == len(r["text"])
        if not plain_base(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
        else:
            assert masks.search(r["text"])


def test_mix(stages):
    words = {s: 0 for s in {r["source"] for r in stages[3].collect()}}
    taken = dict(words)
    for r in stages[3].collect():
        words[r["source"]] += len(WORD.findall(r["text"]))
    for r in stages[4].collect():
        taken[r["source"]] += len(WORD.findall(r["text"]))
    for source, target in plain_targets(words).items():
        assert abs(taken[source] - target) <= 60
    assert {r["doc_id"] for r in stages[4].collect()} <= {r["doc_id"] for r in stages[3].collect()}


def test_codec(stages):
    sp = common.processor(common.model_path())
    wanted = []
    for r in stages[4].collect():
        ids = sp.encode(r["text"]) + [sp.eos_id()]
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    found = [(r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in stages[5].collect()]
    assert sorted(found) == sorted(wanted)


def test_run(spark, sf_dir, stages):
    rows = sorted(map(tuple, cp.run(spark, sf_dir).collect()))
    assert rows == sorted(map(tuple, stages[5].collect()))


def test_empty_and_edge_tables(spark, sf_dir, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        table = docs
        for name, stage in cp.STAGES[:-1]:
            table = common.settled(stage(spark, table, sf_dir), "test")
            assert table.columns == docs.columns, name
        assert cp.STAGES[-1][1](spark, table, sf_dir).count() == table.count()
