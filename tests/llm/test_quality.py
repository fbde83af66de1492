"""Operators 7 and 8."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from assayframe.llm import common, fertility, ordinal_quality as oq

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dups,
        len(inside),
    )


def test_base_counts(given):
    draw = random.Random(5)
    texts = [r["text"] for r in given.values()] + ["", " \x0b\x0c\r", "a b c \x85 d"]
    for _ in range(400):
        n = draw.randint(0, 60)
        texts.append("".join(draw.choice(["a ", "b ", "c\n", "a\n", "é# ", "\t"]) for _ in range(n)))
    for text in texts:
        assert fertility.base_counts(text) == plain_counts(text)


def test_fertility_against_plain_sums(given):
    sp = common.processor(common.model_path())
    scraps = fertility._scraps(common.model_path())
    for text in [r["text"] for r in given.values()][:40] + ["①②③\n", "x"]:
        ids = sp.encode(text)
        share = [n / len(ids) for n in Counter(ids).values()]
        found = fertility.fertility(np.array(ids), len(text), scraps)
        wanted = (
            len(text) / len(ids),
            sum(sp.is_byte(i) and sp.id_to_piece(i) != "<0x0A>" for i in ids) / len(ids),
            -sum(p * np.log2(p) for p in share),
        )
        assert np.allclose(found, wanted)


def test_scripts():
    assert fertility.main_script("hello wörld") == "latin"
    assert fertility.main_script("привет, мир abc") == "cyrillic"
    assert fertility.main_script("1234 !?") == "latin"
    assert fertility.main_script("日本 é") == "cjk"


def test_query(spark, sf_dir, given):
    rows = fertility.query(spark, sf_dir).collect()
    assert len(rows) == len(given)
    for r in rows:
        n, chars, symbols, dups, repeats = plain_counts(given[r["doc_id"]]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (n, chars, symbols)
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (dups, repeats)
        assert r["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        assert not (r["base_failed"] and r["kept"])


def test_bands_reject_scraps_and_keep_clean_texts(spark, given):
    draw = random.Random(6)
    vocabulary = sorted({w for r in given.values() if r["lang"] == "en" for w in r["text"].split()})
    rows = []
    for i in range(400):
        # copies of one text must not narrow the band
        words = draw.choices(vocabulary, k=300) if i > 150 else vocabulary[:300]
        rows.append((i, " ".join(words), "en"))
    for i in range(400, 410):
        rows.append((i, " ".join("①②③" + chr(9312 + draw.randrange(20)) for _ in range(120)), "en"))
        rows.append((i + 10, " ".join("".join(draw.choices("qxzjkvw", k=9)) for _ in range(200)), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["kept"] for r in fertility.rules(docs).collect()}
    assert all(found[i] for i in range(151, 400))
    assert not any(found[i] for i in range(400, 420))


def test_thin_groups_and_octaves_are_judged(spark, given):
    """Junk in a rare language, in an octave of its own, or in a small table."""
    draw = random.Random(8)
    sp = common.processor(common.model_path())
    words = sorted({w for r in given.values() if r["lang"] == "en" for w in r["text"].split()})

    def clean():
        return " ".join(draw.choices(words, k=300))

    def per_token(some):
        return sum(len(w) + 1 for w in some) / sum(len(sp.encode(w)) for w in some)

    junk = [" ".join("".join(draw.choices("qxzjkvw", k=9)) for _ in range(200)) for _ in range(3)]
    few = min((draw.sample(words, 6) for _ in range(300)), key=lambda s: abs(per_token(s) - per_token(words)))
    dull = " ".join(draw.choices(few, k=6_000))  # cut as others are, but of six words
    for n in (300, 30):
        rows = [(i, clean(), "en") for i in range(n)] + [(n, dull, "en")]
        rows += [(n + 1 + i, text, "sv") for i, text in enumerate(junk)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        found = {r["doc_id"]: r for r in fertility.rules(docs).collect()}
        assert all(found[i]["kept"] for i in range(n))
        assert not any(found[i]["kept"] or found[i]["base_failed"] for i in range(n, n + 4))


def test_rules_on_edge_rows(edge_docs, no_docs):
    rows = fertility.rules(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["base_failed"] for r in rows if r["doc_id"] in (2, 3, 4, 6, 9))
    kept = fertility.kept_rows(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)
    assert fertility.rules(no_docs).count() == 0 and fertility.kept_rows(no_docs).count() == 0


# ---------------------------------------------------------------- operator 8


def test_gradient_of_the_likelihood():
    """The fitted model is better than any small step away from it."""
    draw = np.random.default_rng(7)
    places = [np.unique(draw.integers(0, 12, 4)) for _ in range(300)]
    truth = draw.normal(0, 2, 12)
    scores = np.array([truth[p].sum() for p in places]) + draw.logistic(0, 1, 300)
    grades = np.digitize(scores, [-1.0, 1.5])
    model = oq.fit(places, grades)

    def loss(weights, cuts):
        eta = np.array([weights[np.searchsorted(model.places, p)].sum() for p in places])
        tail = 1 / (1 + np.exp(-(eta[:, None] - cuts[None, :])))
        full = np.hstack([np.ones((300, 1)), tail, np.zeros((300, 1))])
        chance = full[np.arange(300), grades] - full[np.arange(300), grades + 1]
        return -np.log(chance).mean() + oq.DECAY / 2 * (weights**2).sum()

    best = loss(model.weights, model.thresholds)
    assert (np.diff(model.thresholds) > 0).all()
    for _ in range(50):
        step = draw.normal(0, 0.2, 12)
        assert loss(model.weights + step, model.thresholds) > best - 1e-3
        assert loss(model.weights, model.thresholds + draw.normal(0, 0.2, 2)) > best - 1e-3


def test_held_out_grades():
    folder = "/root/testdata/sf0.1"
    con = duckdb.connect()
    rows = con.execute(
        f"SELECT text, quality, toxic FROM '{folder}/labels.parquet' JOIN "
        f"'{folder}/documents.parquet' USING (doc_id) ORDER BY md5(doc_id::varchar)"
    ).fetchall()
    hasher = oq.Hasher()
    places = [np.array(hasher.features(t), np.int64) for t, _, _ in rows]
    grades = np.array([0 if toxic else 1 + quality for _, quality, toxic in rows])
    half = len(rows) // 2
    model = oq.fit(places[:half], grades[:half])
    table = dict(zip(model.places.tolist(), model.weights.tolist(), strict=True))
    scores = np.array([sum(table.get(p, 0.0) for p in x.tolist()) for x in places[half:]])
    tails, held = model.tails(scores), grades[half:]
    kept = tails[:, 1] >= oq.KEEP_TAIL
    assert kept[held == 2].mean() > 0.99
    assert kept[held == 1].mean() < 0.35
    insults = re.compile("idiot|moron|scum|worthless|pathetic|stupid|disgusting|trash|loser|clown")
    rude = np.array([bool(insults.search(t.lower())) for t, _, _ in rows[half:]]) & (held == 0)
    assert kept[rude].mean() < 0.1


def test_selection(spark, sf_dir, given):
    rows = oq.query(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(given)
    for r in rows:
        assert r["p_low_or_better"] >= r["p_good"]
        assert abs(r["expected_grade"] - r["p_low_or_better"] - r["p_good"]) < 1e-5
        assert r["kept"] == (r["p_good"] >= oq.KEEP_TAIL)


def test_selection_on_edge_rows(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert all(r["kept"] for r in oq.select_documents(edge_docs, none).collect())
    some = spark.createDataFrame([(1, 2), (5, 0), (5, 1), (None, 1), (7, None)], "doc_id long, grade int")
    assert oq.select_documents(edge_docs, some).count() == edge_docs.count()
    graded = {r["doc_id"]: r["grade"] for r in oq.training_rows(edge_docs, some).collect()}
    assert graded == {1: 2, 5: 0}
    assert oq.training_rows(edge_docs, some, sample=1).count() == 1
    assert oq.select_documents(no_docs, some).count() == 0


@pytest.mark.parametrize(
    ("quality", "toxic", "grade"), [(1, 0, 2), (0, 0, 1), (1, 1, 0), (0, 1, 0), (None, None, None)]
)
def test_grades(spark, quality, toxic, grade):
    labels = spark.createDataFrame([(1, quality, toxic)], "doc_id long, quality int, toxic int")
    assert oq.ratings_of(labels).first()["grade"] == grade
