"""Lempel-Ziv phrase fingerprints (operator 1).

A text is parsed as LZ78 does: the next phrase is the longest one that is already in the text's
dictionary, and one character more. The hashes of all phrases form a set, of which the least K are
the fingerprint. Texts that compress well together share phrases, so the share of common values
among the K least of two fingerprints estimates the likeness of their dictionaries.

The dictionary holds every beginning of its phrases. So the parser guesses a length and moves up or
down from there, and an edit behind some position leaves all phrases before it as they are: the
edited text is parsed from there on only.

``fingerprints`` works row by row. ``compare_with_next`` needs the next document by doc_id: texts
are dealt into blocks of consecutive ids, once, and every block also gets the first row of the
block after it. Ids should be a key; rows that share one follow each other by their text, and a
null id comes last. Null texts are empty texts. Two empty texts have the likeness 1, an empty and
another one 0. An empty table gives an empty result; a single document is next to itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm import common

LEAST = 128  # values in a fingerprint
MAX_BLOCKS = 4096
#: Fixed values of the phrase hash: an odd multiplier and a finisher of public 64-bit mixers.
MULTIPLIER = 0x9E3779B97F4A7C15
FINISH = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = 1 << 16
    inverse = pow(MULTIPLIER, -1, 1 << 64)
    up = np.full(n, MULTIPLIER, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_UP, _DOWN = _powers()


def _power(table: np.ndarray, n: np.ndarray) -> np.ndarray:
    """MULTIPLIER (or its inverse) to the power n, modulo 2**64."""
    low = table[n & 0xFFFF]
    if len(n) == 0 or n[-1] < 1 << 16:
        return low
    step = int(table[-1]) * int(table[1]) % (1 << 64)
    high = np.array([pow(step, k, 1 << 64) for k in range(int(n[-1] >> 16) + 1)], np.uint64)
    return low * high[n >> 16]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(FINISH[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(FINISH[1])
    return x ^ (x >> np.uint64(31))


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """Hashes of the phrases that end at ``ends``, the first starting at 0.

    The sum of character * multiplier ** position over a phrase, divided by the power of its
    start, depends on the phrase alone, wherever it stands.
    """
    if not ends:
        return np.zeros(0, np.uint64)
    letters = np.frombuffer(text[: ends[-1]].encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _mixed(letters.astype(np.uint64) + np.uint64(1))
    before = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * _power(_UP, np.arange(len(letters))), out=before[1:])
    stops = np.array(ends, np.int64)
    starts = np.concatenate([[0], stops[:-1]])
    return _mixed((before[stops] - before[starts]) * _power(_DOWN, starts))


def parse(text: str, seen: set[str], start: int = 0) -> list[int]:
    """Ends of the phrases from ``start`` on; ``seen``, the dictionary, grows by them.

    What is left at the end of the text and is in the dictionary already makes no phrase.
    """
    ends, n, guess = [], len(text), 3
    keep, put = ends.append, seen.add
    while start < n:
        end = start + guess
        if text[start:end] in seen:
            end += 1
            while end <= n and text[start:end] in seen:
                end += 1
            if end > n:
                break
        else:
            if end > n:
                end = n
                if text[start:end] in seen:
                    break
            while end - start > 1 and text[start : end - 1] not in seen:
                end -= 1
        put(text[start:end])
        keep(end)
        guess = end - start
        start = end
    return ends


def least(hashes: np.ndarray) -> np.ndarray:
    """The least values of a set, 32 bits of each."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 8 * LEAST:
        short = np.partition(short, 4 * LEAST)[: 4 * LEAST]
    return np.unique(short)[:LEAST]


def written(values: np.ndarray) -> str:
    return base64.b64encode(values.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of common values among the least of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    again = both[1:] == both[:-1]
    distinct = both[np.concatenate([[True], ~again])][:LEAST]
    return float(np.count_nonzero(both[1:][again] <= distinct[-1]) / len(distinct))


def fingerprint(text: str) -> np.ndarray:
    return least(phrase_hashes(text, parse(text, set())))


def with_edit(text: str, edited: str, same: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of two texts whose first ``same`` characters agree."""
    seen: set[str] = set()
    common_ends = parse(text[:same], seen)
    at = common_ends[-1] if common_ends else 0
    out = []
    for whole in (text, edited):
        own = set(seen) if whole is text else seen
        out.append(least(phrase_hashes(whole, common_ends + parse(whole, own, at))))
    return out[0], out[1]


FINGERPRINT = T.StructType([T.StructField("fingerprint", T.StringType())])


def fingerprints(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of each whole text: base64 of little-endian 32-bit values."""

    def make():
        return lambda texts: [pa.array([written(fingerprint(t)) for t in texts], pa.string())]

    made = common.free_name(docs, "_printed")
    out = common.map_texts(docs, make, FINGERPRINT, made, text)
    return out.withColumn("fingerprint", F.col(f"{made}.fingerprint")).drop(made)


def blocks_of(docs: DataFrame, blocks: int) -> DataFrame:
    """doc_id, text, _block, _more: consecutive ids by block, and after them (_more) the row that
    follows the block's last one. Blocks are cut at quantiles of the ids, which are ids themselves,
    so a block's first id is its cut. The driver holds the cuts only."""
    shares = [i / blocks for i in range(blocks)]
    quantiles = F.percentile_approx("doc_id", shares, 20 * blocks)
    found = docs.agg(F.min("doc_id"), quantiles).first()
    cuts = sorted({found[0], *(found[1] or [])[1:]} - {None})
    bounds = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    last = F.lit(max(0, len(cuts) - 1))
    own = F.when(F.col("doc_id").isNull(), last).otherwise(
        F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))) - 1
    )
    cut = F.coalesce(F.array_position(bounds, F.col("doc_id")), F.lit(0)).cast("int")
    before = F.when(cut == 1, last).when(cut > 1, cut - 2)
    places = F.array(
        F.struct(own.alias("block"), F.lit(False).alias("more")),
        F.struct(before.alias("block"), F.lit(True).alias("more")),
    )
    return docs.withColumn("_to", F.explode(F.filter(places, lambda x: x["block"].isNotNull()))).select(
        "doc_id", "text", F.col("_to.block").alias("_block"), F.col("_to.more").alias("_more")
    )


COMPARED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _pairs(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(doc_id, text, next text, whether the row ends its block) of sorted (doc_id, text, block,
    more)."""
    first = held = None
    for row in rows:
        if held is not None and held[2] != row[2]:
            if not held[3]:
                yield held[0], held[1], first[1], True
            held = None
        if held is None:
            first = row
        elif not held[3]:
            yield held[0], held[1], row[1], row[3]
        held = row
    if held is not None and not held[3]:
        yield held[0], held[1], first[1], True


def _compared(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The rows of COMPARED; a row waits for the fingerprint of the next one."""
    waiting = None
    for doc_id, text, following, ends in _pairs(rows):
        edited = edited_text(text, following)
        mine, other = with_edit(text, edited, len(text) - len(text) // 4)
        if waiting is not None:
            yield (*waiting[:-1], likeness(waiting[-1], mine))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        known = (doc_id, len(text), digest, written(mine), written(other), likeness(mine, other))
        waiting = (*known, mine)
        if ends:
            yield (*known, likeness(mine, fingerprint(following)))
            waiting = None


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for part in common.slices(batch, "text"):
                ids, texts, blocks, more = (c.to_pylist() for c in part.columns)
                yield from zip(ids, [t or "" for t in texts], blocks, more, strict=True)

    names, out = COMPARED.fieldNames(), []
    for row in _compared(rows()):
        out.append(row)
        if len(out) == 500:
            yield _batch(out, names)
            out = []
    if out:
        yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = zip(zip(*rows, strict=True), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=names)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents (doc_id, text) and of their edited texts, and likenesses."""
    blocks = min(MAX_BLOCKS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = blocks_of(docs.select(F.col("doc_id").cast("long"), "text"), blocks)
    order = ["_block", "_more", F.asc_nulls_last("doc_id"), "text"]
    return (
        placed.repartitionById(blocks, "_block")
        .sortWithinPartitions(*order)
        .mapInArrow(_run, COMPARED)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(common.documents(spark, sf_dir, "doc_id", "text"))
