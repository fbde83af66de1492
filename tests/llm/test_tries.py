"""Operator 11: node by node against a trie built in memory; contraction against plain sums."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from assayframe.llm import common, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n int, parent string, p1 string, id int"
COLUMNS = (
    "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
)


def trie_of(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        if rebuild:
            h = zlib.crc32(str(c).encode()) % 9
            turns = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
        path = ()
        members[path].append(c)
        for turn in turns:
            children[path].add(path + (turn,))
            path += (turn,)
            members[path].append(c)
        ends[path].append(c)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, ())
        leaves[path] = sum(leaves[p] for p in below) if below else 1
        own_bytes = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own_bytes + sum(saved[p] for p in below)
    return [
        (
            min(m),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(m),
            len(children.get(p, ())),
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    ]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "x", 1) for r in rows], SCHEMA)


EDGE = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "hi"),
    (1, 1, "assistant", "hi"),  # a repeated row
    (1, 1, "assistant", "ha"),  # a tie of turns
    (1, None, None, None),
    (2, None, "user", None),
    (2, None, None, "first"),
    (5, 3, "user", "hello"),
    (5, 3, "", "hello"),
    (6, 0, "user", "é" * 5000),
    (7, 0, "user", "hello"),
    (0, 0, "user", "zero"),
    (-3, 0, "user", "minus"),
    (-8, 7, "user", "minus"),
    (None, 0, "user", "nobody"),
    (2**62, 0, "user", "far"),
    *[(10 + i, 0, "user", "same") for i in range(20)],
    *[(100 + i % 2, t, "user", f"turn {t}") for i in range(2) for t in range(60)],
]


@pytest.mark.parametrize("rebuild", [True, False])
def test_edges_against_a_trie_in_memory(spark, rebuild):
    df = prefix_trie.conversation_trie(table(spark, EDGE), rebuild=rebuild)
    assert rows_of(df) == sorted(trie_of(EDGE, rebuild), key=str)


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(table(spark, []), rebuild=True).isEmpty()


def test_query_on_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(prefix_trie.query(spark, sf_dir)) == sorted(trie_of(rows), key=str)


def test_sql_against_a_trie_in_memory(sf_dir):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", EDGE)
    wanted = sorted(trie_of(EDGE), key=str)
    assert sorted(con.execute(prefix_trie.SQL).fetchall(), key=str) == wanted


def test_long_conversation_in_blocks_and_tasks(spark, monkeypatch):
    """A conversation over many blocks and sort tasks: places and prefixes are as in one piece."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    rows = [(3, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(4, t, "user", f"turn {t % 7}" if t < 150 else "else") for t in range(160)]
    df = table(spark, rows).repartition(7)
    found = prefix_trie.conversation_trie(df)
    assert rows_of(found) == sorted(trie_of(rows, rebuild=False), key=str)


def random_tree(size, seed, chain):
    draw = random.Random(seed)
    parent = [None]
    for i in range(1, size):
        parent.append(i - 1 if draw.random() < chain else draw.randrange(i))
    return parent


@pytest.mark.parametrize(
    "parent",
    [
        [None],
        [None, *range(200)],
        [None] + [0] * 50,
        random_tree(300, 1, 0.5),
        random_tree(300, 2, 0.95),
        [None, *[x for i in range(60) for x in (2 * i, 2 * i)]],  # a spine with a leaf at each node
    ],
)
def test_contraction_gives_all_subtree_sums(spark, parent):
    draw = random.Random(7)
    value = [draw.randrange(1000) for _ in parent]
    depth, below = [0] * len(parent), [0] * len(parent)
    for i, p in enumerate(parent):
        if p is not None:
            depth[i] = depth[p] + 1
            below[p] += 1
    total = list(value)
    for i in sorted(range(len(parent)), key=lambda i: -depth[i]):
        if parent[i] is not None:
            total[parent[i]] += total[i]
    rows = list(zip(range(len(parent)), parent, depth, below, value, strict=True))
    tree = spark.createDataFrame(rows, "id long, parent long, depth long, n_children long, v long")
    found = prefix_trie.subtree_totals(tree, ["v"]).collect()
    assert sorted(tuple(r) for r in found) == list(enumerate(total))


def test_no_neighbours_leave_in_a_round_and_chains_halve(spark, monkeypatch):
    size = 128
    rows = [(i, i - 1 if i else None, i, int(i < size - 1), 1) for i in range(size)]
    tree = spark.createDataFrame(rows, "id long, parent long, depth long, n_children long, v long")
    states = []
    settled = common.settled
    monkeypatch.setattr(
        prefix_trie.common,
        "settled",
        lambda df, purpose: states.append(settled(df, purpose)) or states[-1]
        if purpose == "round"
        else settled(df, purpose),
    )
    prefix_trie.subtree_totals(tree, ["v"]).count()
    assert len(states) <= 10
    out = {r["id"] for r in states[0].where("fate = 'compressed'").collect()}
    assert len(out) > size // 3 and not any(i + 1 in out for i in out)
