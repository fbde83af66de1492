"""Operator 13: every id once, no padding, target shares in every window, the library's ids."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assayframe.llm import common, mixture_packing
from assayframe.llm.mixture_packing import RoundRobin, pack, pieces_of


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def checked(pieces, window):
    """Sequences by number; fails on gaps, overlaps and padding."""
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, held in sequences.items():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window and at & (at - 1) == 0, number
    return sequences


def test_ids_are_those_of_the_library(library):
    texts = [
        "", " ", "a<|endoftext|>b <|endoftext|>\n", "I'll  it's\n\n x\t", "日本 é \x00 ﬁ​",
        "x" * 150_000, " " * 150_000, "ab " * 60_000, "\n" * 150_000, "é1" * 60_000 + " " + "!" * 120_000,
    ]
    encode = mixture_packing.encoder(mixture_packing.VOCABULARY).encode
    for text in texts:
        assert encode(text).tolist() == ids_of(library, text), text[:20]


def test_edges(spark, edge_docs, library):
    rows = pack(edge_docs, window=64, least=8).collect()
    checked(rows, 64)
    docs = [r for r in edge_docs.collect()]
    wanted = sorted(zlib.crc32(np.array(ids_of(library, d["text"]), "<u4").tobytes()) for d in docs)
    # whole documents from their pieces: equal rows (doc_id 5, null) are told apart by their starts
    groups = {}
    for r in sorted(rows, key=lambda r: (r["start"], r["sequence_id"], r["offset"])):
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        open_ = groups.setdefault((r["doc_id"], r["source"], r["doc_tokens"]), [])
        for g in open_:
            if sum(len(x) for x in g) == 4 * r["start"]:
                g.append(r["ids"])
                break
        else:
            assert r["start"] == 0
            open_.append([r["ids"]])
    assert sorted(zlib.crc32(b"".join(g)) for gs in groups.values() for g in gs) == wanted


def test_empty_table(spark, no_docs):
    assert pack(no_docs).isEmpty()


def test_query_on_the_given_table(spark, sf_dir, given, library):
    rows = mixture_packing.query(spark, sf_dir).collect()
    sequences = checked(rows, 1024)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert by_doc.keys() == given.keys()
    for doc, held in by_doc.items():
        ids, at = ids_of(library, given[doc]["text"]), 0
        for r in sorted(held, key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    # each full window has every source at its share, up to the deficits at its two ends
    tokens = {}
    for r in rows:
        source = given[r["doc_id"]]["source"]
        tokens[source] = tokens.get(source, 0) + r["length"]
    total = sum(tokens.values())
    for number, held in sequences.items():
        if number < total // 1024:
            mix = dict.fromkeys(tokens, 0)
            for r in held:
                mix[given[r["doc_id"]]["source"]] += r["length"]
            for source, n in mix.items():
                assert abs(n - 1024 * tokens[source] / total) <= 2 * len(tokens)


def test_partitions_change_nothing(spark, sf_dir):
    docs = common.documents(spark, sf_dir, "doc_id", "text", "source")
    one = {tuple(r) for r in pack(docs).drop("ids").collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {tuple(r) for r in pack(docs.repartition(5)).drop("ids").collect()} == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def played(tokens, quantum, grains):
    """The stream of deficit round-robin, played round by round: (queue, token) in order."""
    sent, credit, out = [0] * len(tokens), [0] * len(tokens), []
    while any(s < t for s, t in zip(sent, tokens, strict=True)):
        for i, t in enumerate(tokens):
            grain = grains[i]
            credit[i] += quantum[i]
            while credit[i] >= grain << mixture_packing.POINT and sent[i] < t:
                credit[i] -= grain << mixture_packing.POINT
                out += [(i, x) for x in range(sent[i], min(t, sent[i] + grain))]
                sent[i] = min(t, sent[i] + grain)
    return out


@pytest.mark.parametrize("window, least", [(64, 8), (32, 32), (128, 1), (16, 5)])
def test_places_are_those_of_the_rounds_played(window, least):
    tokens = {"a": 700, "b": 331, "c": 5, "d": 90}
    robin = RoundRobin(tokens, {"a": 1.0, "b": 2.0, "c": 0.3, "d": 1.5}, window, least)
    queues = [tokens[k] for k in robin.names]
    stream = played(queues, robin.quantum.tolist(), robin.grain.tolist())
    place = {t: i for i, t in enumerate(stream)}
    draw = np.random.default_rng(1)
    for queue, name in enumerate(robin.names):
        cuts = np.unique(np.concatenate([[0, tokens[name]], draw.integers(0, tokens[name], 6)]))
        first, n = cuts[:-1], np.diff(cuts)
        row, start, length, number, offset = pieces_of(robin, np.full(len(n), queue), first, n)
        assert np.bincount(row, length, len(n)).tolist() == n.tolist()
        tail = robin.cuts()
        full = robin.total // window
        begin = [x * window if x < full else int(tail[x - full]) for x in number.tolist()]
        for r, s, many, b, o in zip(row, start, length, begin, offset, strict=True):
            for j in range(many):
                assert place[(queue, int(first[r] + s + j))] == b + o + j


def test_weights_rule_while_all_queues_last(spark, sf_dir, given):
    docs = common.documents(spark, sf_dir, "doc_id", "text", "source")
    some = sorted({r["source"] for r in given.values()})[:1]
    rows = pack(docs, weights={some[0]: 19.0}).where("sequence_id < 3").collect()
    share = sum(r["length"] for r in rows if r["source"] == some[0]) / (3 * 1024)
    names = len({r["source"] for r in given.values()})
    assert abs(share - 19 / (18 + names)) < 0.05
    with pytest.raises(ValueError):
        RoundRobin({"a": 1}, {"a": 0.0}, 8, 1)
