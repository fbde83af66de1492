"""Operator 4: targets, the knapsack against all subsets, and the mix of whole tables."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np

from assayframe.llm import budget_mix as mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Share by weight, cut at three sizes, share what was cut, until nothing is cut."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    got = {s: total * weight[s] / sum(weight.values()) for s in names}
    while any(got[s] > 3 * sizes[s] + 1e-9 for s in names):
        over = sum(max(0.0, got[s] - 3 * sizes[s]) for s in names)
        got = {s: min(got[s], 3 * sizes[s]) for s in names}
        room = [s for s in names if got[s] < 3 * sizes[s] - 1e-9]
        if not room:
            break
        for s in room:
            got[s] += over * weight[s] / sum(weight[r] for r in room)
    return got


def test_targets():
    draw = random.Random(1)
    for _ in range(300):
        names = draw.sample(["a", "b", "c", "ä", "Z", None, "d"], draw.randint(1, 7))
        sizes = {n: draw.choice([0, 1, 5, 80, 1000]) for n in names}
        found, wanted = mix.targets_of(list(sizes.items())), plain_targets(sizes)
        assert found.keys() == wanted.keys()
        assert all(abs(found[n] - wanted[n]) < 1e-6 * max(1, wanted[n]) for n in names)


def test_nearest_sum_against_all_subsets():
    draw = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted(draw.sample(range(1, 30), 3)))
        counts = np.array([draw.randint(0, 4) for _ in lengths])
        rest = draw.randint(0, 60)
        taken = mix.nearest_sum(lengths, counts, rest)
        assert (0 <= taken).all() and (taken <= counts).all()
        best = min(
            abs(rest - int(np.dot(lengths, k)))
            for k in itertools.product(*[range(c + 1) for c in counts])
        )
        assert abs(rest - int(taken @ lengths)) == best


def test_fit_reaches_large_budgets():
    draw = np.random.default_rng(3)
    lengths = np.unique(np.append(draw.integers(1, 9_000, 1_500), 1))  # so each sum can be made
    counts = draw.integers(1, 60, len(lengths))
    total = int((lengths * counts).sum())
    for budget in (1, 999, total // 3, total - 1):
        taken = mix.fit(lengths, counts, budget)
        assert (0 <= taken).all() and (taken <= counts).all()
        assert int((taken * lengths).sum()) == budget
    few = mix.fit(np.array([100_000]), np.array([5]), 260_000)
    assert few.tolist() == [3]


def test_fit_with_few_lengths_and_very_long_documents():
    for lengths, counts, budget in (
        ([100, 200_000], [3_000, 1], 250_000),  # several of one length
        ([1_000, 400_000], [100, 1], 450_000),  # the long one for shorter ones
    ):
        lengths, counts = np.array(lengths), np.array(counts)
        taken = mix.fit(lengths, counts, budget)
        assert (0 <= taken).all() and (taken <= counts).all()
        assert int(taken @ lengths) == budget
    draw = random.Random(4)
    for _ in range(300):
        lengths = np.array(sorted(draw.sample(range(50_000, 400_000), 3)))
        counts = np.array([draw.randint(1, 4) for _ in lengths])
        budget = draw.randint(1, int(lengths @ counts) - 1)
        taken = mix.fit(lengths, counts, budget)
        assert (0 <= taken).all() and (taken <= counts).all()
        assert abs(int(taken @ lengths) - budget) <= int(lengths.max()) // 2


def check(rows, given):
    """given: doc_id -> (text, source), rows of the operator with the same documents."""
    sizes, taken = defaultdict(int), defaultdict(int)
    for text, source in given:
        sizes[source] += len(WORD.findall(text or ""))
    targets = plain_targets(sizes)
    found = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        found[(r["source_size"], round(r["target"], 6))] = True
    assert set(found) == {(sizes[s], round(targets[s], 6)) for s in sizes}
    return targets, taken


def test_query(spark, sf_dir, given):
    rows = mix.query(spark, sf_dir).collect()
    assert len(rows) == len(given)
    targets, _ = check(rows, [(r["text"], r["source"]) for r in given.values()])
    taken = defaultdict(int)
    for r in rows:
        text = given[r["doc_id"]]["text"]
        assert r["size"] == len(WORD.findall(text))
        taken[given[r["doc_id"]]["source"]] += r["taken"]
    for source, target in targets.items():
        shortest = min(len(WORD.findall(g["text"])) for g in given.values() if g["source"] == source)
        assert abs(taken[source] - target) <= max(shortest, 1)
    assert sorted(map(tuple, mix.query(spark, sf_dir).collect())) == sorted(map(tuple, rows))


def test_edge_rows(edge_docs, no_docs):
    rows = mix.taken(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    check(rows, [(r["text"], r["source"]) for r in edge_docs.collect()])
    assert mix.taken(no_docs).count() == 0
    assert mix.mixed_rows(no_docs).columns == no_docs.columns
    mixed = mix.mixed_rows(edge_docs)
    assert mixed.columns == edge_docs.columns
    words = sum(len(WORD.findall(r["text"])) for r in mixed.collect())
    assert words == sum(r["taken"] for r in rows)


def test_a_length_that_many_documents_share(spark):
    docs = spark.range(4_000).selectExpr(
        "id AS doc_id", "concat('w', id, ' x y') AS text", "if(id < 3000, 'a', 'b') AS source"
    )
    rows = mix.taken(docs).collect()
    taken = defaultdict(int)
    for r in rows:
        taken["a" if r["doc_id"] < 3000 else "b"] += r["taken"]
    assert abs(taken["a"] - 4_000) <= 2 and abs(taken["b"] - 8_000) <= 2
