"""Operator 1 against a character-by-character parser and exact phrase sets."""

import hashlib
import random

import numpy as np

from assayframe.llm import lz_fingerprint as lz


def plain_phrases(text):
    seen, phrase = set(), ""
    for letter in text:
        phrase += letter
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def plain_likeness(a, b):
    x, y = plain_phrases(a), plain_phrases(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def some_texts(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        letters = draw.choice(["ab", "abcdé ", "日本語 "])
        yield "".join(draw.choices(letters, k=draw.randint(0, 150)))


def test_parse_and_edit():
    for text in some_texts(600, 1):
        seen = set()
        lz.parse(text, seen)
        assert seen == plain_phrases(text)
        edited = lz.edited_text(text, "xyab" * 40)
        mine, other = lz.with_edit(text, edited, len(text) - len(text) // 4)
        assert (mine == lz.fingerprint(text)).all()
        assert (other == lz.fingerprint(edited)).all()


def test_hash_depends_on_the_phrase_alone():
    inner = lz.phrase_hashes("z" * 70_000 + "abc", [70_000, 70_003])[1]
    assert lz.phrase_hashes("abc", [3])[0] == inner


def test_likeness_is_exact_for_short_texts():
    texts = list(some_texts(80, 2))
    for a, b in zip(texts, texts[1:], strict=False):
        if len(plain_phrases(a) | plain_phrases(b)) <= lz.LEAST:
            found = lz.likeness(lz.fingerprint(a), lz.fingerprint(b))
            assert abs(found - plain_likeness(a, b)) < 1e-12


def test_likeness_estimates_long_texts(given):
    texts = sorted((r["text"] for r in given.values()), key=len)[-20:]
    off = []
    for a, b in zip(texts, texts[1:], strict=False):
        c = a[: len(a) // 2] + b[: len(b) // 2]
        off.append(lz.likeness(lz.fingerprint(a), lz.fingerprint(c)) - plain_likeness(a, c))
    assert np.abs(off).mean() < 0.05


def wanted_rows(rows):
    """(doc_id, text) in order of id, null last, then text; each with its next one."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for at, (doc_id, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        edited = lz.edited_text(text, following)
        yield (
            str(doc_id),
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            lz.written(lz.fingerprint(text)),
            lz.written(lz.fingerprint(edited)),
            lz.likeness(lz.fingerprint(text), lz.fingerprint(edited)),
            lz.likeness(lz.fingerprint(text), lz.fingerprint(following)),
        )


def check(df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    found = [(str(r[0]), *r[1:]) for r in lz.compare_with_next(df).collect()]
    assert sorted(found) == sorted(wanted_rows(rows))


def test_rows(spark, edge_docs, no_docs, sf_dir):
    check(edge_docs)
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    check(edge_docs.where("doc_id = 1"))
    check(edge_docs.where("doc_id IS NULL"))
    assert lz.compare_with_next(no_docs).count() == 0


def test_blocks_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "3", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(map(tuple, lz.compare_with_next(docs).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] == out[2] and len(out[0]) == 40


def test_fingerprints_keep_other_columns(edge_docs):
    found = lz.fingerprints(edge_docs)
    assert found.columns == [*edge_docs.columns, "fingerprint"]
    prints = {r["doc_id"]: r["fingerprint"] for r in found.collect()}
    assert prints[1] == prints[5] and prints[2] == prints[3] == ""
