"""Operators 3 and 6 against the library."""

import hashlib
import random

import numpy as np
import pytest

from assayframe.llm import common, piece_codec, pieces, prefix_counts

NASTY = ["", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "▁a ▁", "x" * 400 + " y", "日本 é①\n \t z"]


@pytest.fixture(scope="module")
def sp():
    return common.processor(common.model_path())


@pytest.fixture(scope="module")
def texts(given):
    draw = random.Random(4)
    letters = "abtheinr  \n.1é日①▁"
    made = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(500)]
    return NASTY + made + [r["text"] for r in given.values()]


def test_marked_words_have_all_of_the_text():
    for text in NASTY:
        whole = "".join("▁" + w.replace(" ", "▁") for w in pieces.marked_words(text))
        assert whole == ("▁" + text.replace(" ", "▁") if text else "")


def test_ids_and_decoded_texts(texts, sp):
    (lists,) = piece_codec._encoder(common.model_path(), True)(texts)
    found = lists.to_pylist()
    wanted = [ids + [sp.eos_id()] for ids in sp.encode(texts)]
    assert found == wanted
    flat = np.array([i for ids in wanted for i in ids])
    counts = np.array([len(ids) for ids in wanted])
    decoded = piece_codec.decode_ids(flat, counts, common.model_path())
    assert decoded == [sp.decode(ids) for ids in wanted]


def test_a_full_table_changes_nothing(texts, sp, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 10)
    monkeypatch.setattr(pieces, "KEPT_LENGTH", 3)
    table = pieces.ChunkTable(pieces.id_table(common.model_path()).work_out)
    for start in range(0, len(texts), 50):
        part = texts[start : start + 50]
        values, per_text, _, _ = table.joined(part)
        assert values.tolist() == [i for ids in sp.encode(part) for i in ids]
        assert per_text.tolist() == [len(ids) for ids in sp.encode(part)]


def test_counts_of_every_prefix(texts, sp):
    budget = 12
    lists, fits = prefix_counts._counter(common.model_path(), budget)(texts)
    for text, table, fit in zip(texts, lists.to_pylist(), fits.to_pylist(), strict=True):
        assert len(table) == len(text) + 1
        at = range(len(text) + 1) if len(text) < 60 else range(0, len(text) + 1, len(text) // 40)
        assert [table[i] for i in at] == [len(x) for x in sp.encode([text[:i] for i in at])]
        assert table[-1] == len(sp.encode(text))
        assert fit == max(i for i, n in enumerate(table) if n <= budget)


def test_questions_to_the_table(spark):
    df = spark.createDataFrame([("one two three four five",)], "text string")
    with_table = prefix_counts.with_prefix_counts(df)
    from pyspark.sql import functions as F

    row = with_table.select(
        "counts",
        prefix_counts.tokens_of_prefix(F.col("counts"), F.lit(7)).alias("seven"),
        prefix_counts.tokens_of_prefix(F.col("counts"), F.lit(999)).alias("all"),
        prefix_counts.longest_within(F.col("counts"), F.lit(3)).alias("fits"),
    ).first()
    assert row["seven"] == row["counts"][7]
    assert row["all"] == row["counts"][-1]
    assert row["fits"] == max(i for i, n in enumerate(row["counts"]) if n <= 3)


def test_edge_rows(edge_docs, no_docs, sp):
    rows = edge_docs.collect()
    wanted = sorted(
        (str(r["doc_id"]), hashlib.sha256(sp.decode(sp.encode(r["text"] or "")).encode()).hexdigest())
        for r in rows
    )
    found = piece_codec.digests(edge_docs).collect()
    assert sorted((str(r["doc_id"]), r["decoded_sha256"]) for r in found) == wanted
    counted = prefix_counts.token_counts(edge_docs).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in counted) == sorted(
        (str(r["doc_id"]), len(sp.encode(r["text"] or ""))) for r in rows
    )
    assert {r["over_limit"] for r in counted if r["doc_id"] == 6} == {True}
    assert piece_codec.digests(no_docs).count() == 0
    assert prefix_counts.token_counts(no_docs).count() == 0


def test_encode_and_decode_as_operators(edge_docs, sp):
    coded = piece_codec.decode(piece_codec.encode(edge_docs))
    assert coded.columns == [*edge_docs.columns, "decoded"]  # the column ids is replaced
    for r in coded.collect():
        assert r["ids"] == sp.encode(r["text"] or "") + [sp.eos_id()]
        assert r["decoded"] == sp.decode(r["ids"])
    bare = piece_codec.encode(edge_docs, end=False, ids="own").select("text", "own").collect()
    assert all(r["own"] == sp.encode(r["text"] or "") for r in bare)
    none = coded.selectExpr("doc_id", "cast(null AS array<int>) AS ids")
    assert {r["decoded"] for r in piece_codec.decode(none).collect()} == {""}


def test_queries_against_the_library(spark, sf_dir, given, sp):
    for r in piece_codec.query(spark, sf_dir).collect():
        ids = sp.encode(given[r["doc_id"]]["text"]) + [sp.eos_id()]
        joined = " ".join(map(str, ids)).encode()
        decoded = sp.decode(ids).encode()
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(joined).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded).hexdigest()
    for r in prefix_counts.query(spark, sf_dir).collect():
        text = given[r["doc_id"]]["text"]
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(sp.encode(text))
        assert r["over_limit"] == (r["n_tokens"] > 4096)
