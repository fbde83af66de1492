"""Operator 10 against all pairs, with small and large nodes, blocks and groups of copies."""

import random

import numpy as np
import pytest

from assayframe.llm import chosen_path as cp
from assayframe.llm.components import components


def plain_grams(text):
    words = (text or "").encode().split()
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_classes(rows):
    """(class, links) of every row (doc_id, text) by comparing all pairs."""
    sets = [plain_grams(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = root(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(d, least.get(root(i)), links[i]) for i, (d, _) in enumerate(rows)]


def text(draw, n):
    return [draw.choice("abcdefghijkl") + draw.choice("mnopqrst") for _ in range(n)]


def corpus(seed, groups=12, copies=14, singles=60):
    """Groups of near copies at many distances, exact copies, passages that many texts share."""
    draw, rows = random.Random(seed), []
    shared = text(draw, 25)
    for _ in range(groups):
        base = text(draw, draw.randint(8, 160))
        for _ in range(draw.randint(1, copies)):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
                words[draw.randrange(len(words))] = draw.choice(["x", "y", "z"])
            rows.append(words)
    for _ in range(singles):
        rows.append(text(draw, draw.randint(1, 80)) + shared * draw.randint(0, 1))
    draw.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in cp.classes(df).collect()]
    key = lambda r: (str(r[0]), str(r))
    assert sorted(found, key=key) == sorted(plain_classes(rows), key=key)


def test_against_all_pairs(spark):
    check(spark, corpus(1))


def test_large_nodes_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cp, "TASK_SETS", 25)
    monkeypatch.setattr(cp, "LEAF_SETS", 6)
    monkeypatch.setattr(cp, "BLOCK_SETS", 7)
    check(spark, corpus(2, groups=3, copies=60, singles=20))


@pytest.mark.parametrize("grams", [60, 400])
def test_components_of_blocks_that_may_be_empty(spark, monkeypatch, grams):
    """Pairs count once where a component has more blocks than sets."""
    monkeypatch.setattr(cp, "BLOCK_GRAMS", grams)
    check(spark, corpus(8, groups=24, copies=2, singles=5))


def test_blocks_of_unlike_sizes_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK_SETS", 10)
    rows = [(i, 7, 1, 100 + 40 * i, i, i) for i in range(60)]
    schema = "sid long, root long, copies long, grams int, doc_id long, text_hash long"
    placed = cp._blocks(spark.createDataFrame(rows, schema)).collect()
    level = {r["sid"]: (r["grams"], r["level"]) for r in placed}
    assert {r["sid"] for r in placed} == set(range(60))
    for r in placed:
        others = {o["level"] for o in r["others"]}
        for grams, other in level.values():
            if 0.8 <= r["grams"] / grams <= 1.25:
                assert other in others
        assert max(others) - min(others) <= 2


def test_deep_nodes_get_more_trees(spark, monkeypatch):
    """Every pair is found where passages that many texts share send sets far down."""
    monkeypatch.setattr(cp, "TASK_SETS", 30)
    draw, asked = random.Random(9), []
    monkeypatch.setattr(cp, "_trees", lambda sets, runs, f=cp._trees: asked.append(runs) or f(sets, runs))
    shared, rows = text(draw, 60), []
    for _ in range(150):
        words = shared + text(draw, draw.randint(20, 40))
        rows.append(words)
        if draw.random() < 0.5:
            rows.append([*words[:-1], "y"])
    check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])
    assert len(asked) > 1 and asked[0] == range(cp.runs_for()) and asked[1].start == asked[0].stop


def test_below_the_deepest_level_all_sets_meet():
    draw = np.random.default_rng(12)
    mins = draw.integers(0, 3, (300, cp.COORDINATES)).astype("<u4")  # a third alike, nowhere equal
    mins[200:] = np.where(draw.random((100, 1, )) < 2, mins[:100], mins[200:])
    mins[200:, :8] += 7
    parts, pairs, levels = cp.leaves(3, mins, deepest=0)
    label = cp.held_together(parts, pairs, mins)
    assert (label[200:] == label[:100]).all() and levels.max() == 0


def test_recall_on_a_given_table(spark):
    """Linked documents of a thousand, against all pairs."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    shingler = cp.Shingler()
    ids = sorted(texts)
    links = cp.exact_links([shingler.grams(texts[i] or "") for i in ids])
    found = {r["doc_id"]: r["n_links"] for r in cp.classes(df).collect()}
    reached = sum(found[i] for i in ids) / links.sum()
    assert 0.99 <= reached <= 1


def test_recursion_inside_a_task(monkeypatch):
    """Whatever is linked is held together, also where nodes split many times."""
    monkeypatch.setattr(cp, "LEAF_SETS", 6)
    rows = corpus(3, groups=4, copies=80, singles=40)
    shingler = cp.Shingler()
    grams = [shingler.grams(t) for _, t in rows]
    mins = np.stack([cp.min_hashes(g) for g in grams])
    links = cp.exact_links(grams)
    lost = 0
    for node in range(5):
        parts, pairs, _ = cp.leaves(node, mins)
        label = cp.held_together(parts, pairs, mins)
        a, b = np.nonzero(links)
        lost += int((label[a] != label[b]).sum())
    assert lost < 0.2 * 5 * links.sum()


def test_exact_links_count_rare_and_frequent_grams():
    rows = corpus(4, groups=2, copies=90, singles=30)
    shingler = cp.Shingler()
    links = cp.exact_links([shingler.grams(t) for _, t in rows])
    assert links.sum(axis=1).tolist() == [n for _, _, n in plain_classes(rows)]


def test_min_hashes_estimate_similarity():
    draw = np.random.default_rng(5)
    off = []
    for _ in range(60):
        a = draw.integers(0, 1 << 62, 400).astype(np.uint64)
        b = np.concatenate([a[:350], draw.integers(0, 1 << 62, 50).astype(np.uint64)])
        off.append((cp.min_hashes(a) == cp.min_hashes(b)).mean() - 350 / 450)
    assert abs(np.mean(off)) < 0.02


def test_trees_reach_the_recall():
    """Pairs at the threshold meet in the children of some root with the promised chance."""
    draw = np.random.default_rng(6)
    chosen = [cp._sampled(run + 1) for run in range(cp.runs_for())]
    lost = 0
    for _ in range(3_000):
        same = draw.random(cp.COORDINATES) < cp.THRESHOLD
        lost += not any(same[i] for coordinates in chosen for i in coordinates)
    assert lost <= 3
    assert np.mean([len(cp._sampled(n)) for n in range(4_000)]) == pytest.approx(1.25, abs=0.03)


def test_components(spark):
    draw = random.Random(7)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(230)]
    edges += [(1_000 + i, 1_001 + i) for i in range(90)] + [(5, 5), (2_000, 2_000)]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    wanted = {x: root(x) for x in parent}
    assert {r["node"]: r["root"] for r in found} == wanted
    assert len(found) == len(wanted)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    found = [tuple(r) for r in cp.classes(edge_docs).collect()]
    wanted = [
        (d, c if plain_grams(t) else d, n)
        for (d, c, n), (_, t) in zip(plain_classes(rows), rows, strict=True)
    ]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    firsts = cp.first_of_each(edge_docs)
    assert firsts.columns == edge_docs.columns
    # 1 and 5 are equal, 9 and 10 too; 2, 3, 4 and one row without id have no words
    assert sorted(str(r["doc_id"]) for r in firsts.collect()) == sorted(
        map(str, [1, 2, 3, 4, 6, 7, 8, 9, 11, None, None])
    )
    assert cp.classes(no_docs).count() == 0 and cp.first_of_each(no_docs).count() == 0


def test_query(spark, sf_dir, given):
    rows = [(i, r["text"]) for i, r in given.items()]
    found = sorted(map(tuple, cp.query(spark, sf_dir).collect()))
    assert found == sorted(plain_classes(rows))


def test_sets_of_many_nodes_are_looked_up_once(spark):
    sets = spark.createDataFrame([(s, bytes([s])) for s in range(5)], "sid long, mins binary")
    entries = spark.createDataFrame([(n, n % 4) for n in range(40)] + [(7, 3)], "node long, sid long")
    found = cp._with_mins(entries, sets)
    assert sorted(map(tuple, found.collect())) == sorted((n, s, bytes([s])) for n, s in entries.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    generate, join, aggregate = (plan.index(x) for x in ("Generate explode", "Join Inner", "Aggregate [sid"))
    assert generate < join < aggregate  # rows of nodes come after the join, not out of it


def test_later_trees_leave_out_what_is_held_together(spark, monkeypatch):
    """A group of near copies is one component after the first trees; the others need no rows of it."""
    monkeypatch.setattr(cp, "LEAF_SETS", 3)
    draw, passes, rows = random.Random(10), [], []
    base = text(draw, 200)
    for _ in range(120):
        words = list(base)
        for place in draw.sample(range(200), 2):
            words[place] = draw.choice(["x", "y", "z"])
        rows.append(words)

    def trees(sets, runs, f=cp._trees):
        passes.append([len(runs), 0])
        return f(sets, runs)

    def with_mins(entries, sets, f=cp._with_mins):
        passes[-1][1] += entries.count()
        return f(entries, sets)

    monkeypatch.setattr(cp, "_trees", trees)
    monkeypatch.setattr(cp, "_with_mins", with_mins)
    check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])
    (few, first), (_, later) = passes[:2]
    assert first > 120 * few / 2 and later == 0


def test_later_trees_still_join_components(spark):
    """Nodes of sets from two components are looked at whole."""
    shingler, draw = cp.Shingler(), random.Random(11)
    base = text(draw, 100)
    mins = bytearray(cp.min_hashes(shingler.grams(" ".join(base))).tobytes())
    rows = [(1, mins, 1), (2, mins, 1), (3, mins, 3)]
    sets = spark.createDataFrame(rows, "sid long, mins binary, root long")
    edges = cp._trees(sets, range(4))
    found = {r["node"]: r["root"] for r in components(edges.where("v IS NOT NULL").select("u", "v")).collect()}
    assert found == {1: 1, 2: 1, 3: 1}
    assert cp._trees(sets.where("root = 1"), range(4)).isEmpty()


def test_only_deep_sets_get_more_trees(spark, monkeypatch):
    """Sets of a split node that no tree sends beyond LEVELS take no part in later trees."""
    draw, sizes, rows = random.Random(13), [], []
    monkeypatch.setattr(cp, "LEAF_SETS", 3)
    monkeypatch.setattr(cp, "LEVELS", 2)

    def trees(sets, runs, f=cp._trees):
        sizes.append((sets.count(), len(runs)))
        return f(sets, runs)

    monkeypatch.setattr(cp, "_trees", trees)
    base = text(draw, 200)
    for _ in range(80):  # near copies, and texts that share a passage
        words = list(base)
        for place in draw.sample(range(200), 2):
            words[place] = draw.choice(["x", "y", "z"])
        rows += [words, base[:20] + text(draw, 80)]
    check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])
    assert len(sizes) > 1 and 0 < sizes[1][0] < 120
    spent = sum(cp.lost_within(d) ** n for d, n in [(3, cp.runs_for(levels=3)), (6, cp.runs_for(1 - 2e-6, 6))])
    assert spent <= 1 - cp.RECALL


def test_a_leaf_of_many_sets_needs_no_more_trees(spark, monkeypatch):
    """Near copies and texts that share a passage, more than are compared pair by pair."""
    draw, asked, rows = random.Random(14), [], []
    monkeypatch.setattr(cp, "_trees", lambda sets, runs, f=cp._trees: asked.append(runs) or f(sets, runs))
    base = text(draw, 200)
    for _ in range(110):
        words = list(base)
        for place in draw.sample(range(200), 3):
            words[place] = draw.choice(["x", "y", "z"])
        rows += [words, base[:100] + text(draw, 80)]
    check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])
    assert asked == [range(cp.runs_for())]


def test_pivots_of_a_leaf_lose_no_link():
    shingler = cp.Shingler()
    grams = [shingler.grams(t) for _, t in corpus(15, groups=6, copies=80, singles=80)]
    mins = np.stack([cp.min_hashes(g) for g in grams])
    rows = np.arange(len(mins))
    assert len(rows) > cp.PAIR_SETS
    pairs = cp.by_pivots(rows, mins)
    assert len(pairs) < len(rows)
    label = cp.held_together([rows], [], mins)
    a, b = np.nonzero(cp.exact_links(grams))
    assert (label[a] == label[b]).all()


def test_stars_are_components_at_once(spark, monkeypatch):
    from assayframe.llm import components as module

    written = []
    monkeypatch.setattr(module, "settled", lambda df, name, f=module.settled: written.append(name) or f(df, name))
    edges = [(i, i % 3) for i in range(3, 40)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: i % 3 for i in range(40)} and len(written) == 1
    components(spark.createDataFrame([(3, 2), (2, 1)], "u long, v long"))
    assert len(written) > 2
