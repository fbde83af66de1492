"""Packing documents into windows at target token proportions by deficit round-robin (operator 13).

Every source is a queue of its documents, in the order of a seeded hash. In each round a queue
earns its quantum, the target share of a window's tokens, and sends the whole tokens that its credit
covers; what is left of the credit is its deficit, which the next round adds to. A source whose quantum
is below LEAST tokens waits until it can send as many. A queue that is empty sends no more, and the
others go on. Windows are cut from the stream of all rounds and are full. A round is short of a
window by the deficits, at most a token for each source (LEAST for a small one), so a window holds each
source at its share up to that. What the last window lacks is cut into windows of powers of two,
so nothing is padded at all.

After r rounds a queue has sent ``min(tokens, grain * floor(r * quantum / grain))``, where the grain is
one token, or LEAST. So a task knows all deficits at any round from the round's number, and finds the place of its documents without
the windows before them: deficits carry over windows and partitions by this sum, not by a message.

Documents are spread by (source, hash) ranges and encoded once; the ids are written, with each
document's place among its source's in the same task. A table with one row for each task and source
then says where a task's part of a queue begins. Which rows a task got does not change the result.

Null and empty texts have the end id alone. A null source is a source. Equal hashes go by doc_id,
then text. Repeated rows are each packed. Weights, where given, are for named sources (others: 1); without, a
source's weight is its number of tokens, which empties all queues together. An empty table gives
an empty result. The driver holds one row for each source; sources are named by people.
"""

from __future__ import annotations

import zlib
from base64 import b64decode
from collections.abc import Iterator, Mapping
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayframe.llm import common

VOCABULARY = "byte_bpe_50k"
END = 0
WINDOW = 1024
LEAST = 16  # tokens that a small source sends at a time
SEED = 9_176
BROADCAST_PARTS = 500_000  # of about 40 bytes
POINT = 16  # binary places of a quantum
SPECIAL = "<|endoftext|>"
LONG_RUN = 100_000  # bytes without a break, from which the slower library takes over

ENCODED = "source_key string, ids binary, n long, within long, part int"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of texts as the tokenizers library gives them, by the faster library of the same ranks."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        self.slow_path = public_tokenizers.path(f"{vocabulary}.json")
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            vocabulary,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={SPECIAL: len(ranks)},
        )
        self.dtype = np.dtype("<u2" if len(ranks) < 1 << 16 else "<u4")

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.slow_path)

    def encode(self, text: str) -> np.ndarray:
        if len(text) > LONG_RUN and max(map(len, text.split(" "))) > LONG_RUN:
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode(text, allowed_special={SPECIAL}, disallowed_special=())
        return np.asarray([*ids, END], self.dtype)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def source_key(source: Column) -> Column:
    """The source as a string that tells null from all names."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, seed: int = SEED) -> DataFrame:
    """doc_id, source_key, ids, n (tokens), part (task) and within: the tokens of the documents of
    the same source before it in its part. Parts follow each other in the order of the queues."""
    queue = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        source_key(F.col("source")).alias("source_key"),
        F.xxhash64(F.lit(seed), "doc_id").alias("draw"),
    )
    spread = queue.repartitionByRange("source_key", "draw", "doc_id").sortWithinPartitions(
        "source_key", "draw", "doc_id", "text"
    )
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ENCODED}"
    fields = T._parse_datatype_string(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        last, before = None, 0
        for batch in batches:
            for rows in common.slices(batch, "text"):
                keys = rows.column("source_key").to_pylist()
                ids = [encode(t) for t in rows.column("text").to_pylist()]
                within = []
                for key, one in zip(keys, ids, strict=True):
                    if key != last:
                        last, before = key, 0
                    within.append(before)
                    before += len(one)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("source_key"),
                        pa.array([one.tobytes() for one in ids], pa.binary()),
                        pa.array([len(one) for one in ids], pa.int64()),
                        pa.array(within, pa.int64()),
                        pa.array([part] * len(ids), pa.int32()),
                    ],
                    names=fields,
                )

    return spread.mapInArrow(run, schema)


class RoundRobin:
    """What each queue has sent after any number of rounds."""

    def __init__(self, tokens: Mapping[str, int], weights: Mapping[str, float], window: int, least: int):
        self.names = sorted(tokens)
        self.place = {name: i for i, name in enumerate(self.names)}
        self.tokens = np.array([tokens[name] for name in self.names], np.int64)
        share = np.array([weights[name] for name in self.names], float)
        if (share <= 0).any():
            raise ValueError("weights must be above zero")
        exact = share / share.sum() * window * (1 << POINT)
        self.quantum = np.maximum(1, np.rint(exact)).astype(np.int64)
        #: queues that send something in each round
        self.steady = self.quantum >= least << POINT
        self.grain = np.where(self.steady, 1, least)
        self.window = window
        self.total = int(self.tokens.sum())
        #: the round after which a queue is empty
        whole = -(-self.tokens // self.grain) * self.grain
        self.dry = -(-(whole << POINT) // self.quantum)

    def sent(self, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        earned = np.minimum(rounds, self.dry[queue]) * self.quantum[queue] >> POINT
        return np.minimum(self.tokens[queue], earned // self.grain[queue] * self.grain[queue])

    def round_of(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The round that sends a token, by its place in the queue."""
        needed = (token // self.grain[queue] + 1) * self.grain[queue] << POINT
        return -(-needed // self.quantum[queue]) - 1

    def start(self, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """The place in the stream of all rounds where a round comes to a queue."""
        out = np.zeros(len(rounds), np.int64)
        for other in range(len(self.names)):
            ahead = (other < queue).astype(np.int64)
            out += self.sent(np.full(len(rounds), other), rounds + ahead)
        return out

    def cuts(self) -> np.ndarray:
        """Starts of the sequences behind the last full window, and the end of all tokens."""
        at, starts = self.total // self.window * self.window, []
        while at < self.total:
            starts.append(at)
            at += 1 << ((self.total - at).bit_length() - 1)
        return np.array([*starts, self.total], np.int64)


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, each repeated by its count, and 0, 1, 2... inside each row."""
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, inside


def pieces_of(
    robin: RoundRobin, queue: np.ndarray, first: np.ndarray, n: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Pieces of documents that begin at ``first`` in their queues and have ``n`` tokens.

    Returns row, start in the document, length, sequence and offset, in order of row and start.
    """
    # what each round sends of a document; of a small source, each grain
    end, steady, grain = first + n, robin.steady[queue], robin.grain[queue]
    low = np.where(steady, robin.round_of(queue, first), first // grain)
    high = np.where(steady, robin.round_of(queue, end - 1), (end - 1) // grain)
    row, inside = _expand(high - low + 1)
    q, g, number = queue[row], grain[row], low[row] + inside
    rounds = np.where(steady[row], number, robin.round_of(q, number * g))
    sent = robin.sent(q, rounds)
    low = np.maximum(first[row], np.where(steady[row], sent, number * g))
    high = np.minimum(end[row], np.where(steady[row], robin.sent(q, rounds + 1), (number + 1) * g))
    at = robin.start(q, rounds) - sent + low
    # cut at windows, and behind the last full one at its powers of two
    tail = robin.cuts()
    full = int(tail[0])

    def sequence(place: np.ndarray) -> np.ndarray:
        behind = np.searchsorted(tail, place, side="right") - 1
        return np.where(place < full, place // robin.window, full // robin.window + behind)

    def begins(number: np.ndarray) -> np.ndarray:
        behind = np.clip(number - full // robin.window, 0, len(tail) - 1)
        return np.where(number < full // robin.window, number * robin.window, tail[behind])

    from_, to = sequence(at), sequence(at + high - low - 1)
    part, step = _expand(to - from_ + 1)
    number = from_[part] + step
    open_ = np.maximum(at[part], begins(number))
    close = np.minimum((at + high - low)[part], begins(number + 1))
    row, begin = row[part], low[part] + open_ - at[part]
    # join what follows in document, window and stream alike
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1]) | (open_[1:] != close[:-1])
    heads = np.flatnonzero(new)
    length = np.add.reduceat(close - open_, heads) if len(heads) else heads
    row, number, open_, begin = row[heads], number[heads], open_[heads], begin[heads]
    return row, begin - first[row], length, number, open_ - begins(number)


def pack(
    docs: DataFrame,
    *,
    weights: Mapping[str | None, float] | None = None,
    window: int = WINDOW,
    least: int = LEAST,
    vocabulary: str = VOCABULARY,
    seed: int = SEED,
) -> DataFrame:
    """Pieces of documents (doc_id, text, source): doc_id, source, start, length, ids_crc32,
    doc_tokens, sequence_id, offset and ids, the token ids of the piece (little-endian, 32 bits)."""
    made = common.settled(encoded(docs, vocabulary, seed), "tokens")
    parts = common.settled(
        made.groupBy("source_key", "part").agg(F.sum("n").alias("tokens")), "parts"
    )
    # one row for each source
    tokens = {
        r["source_key"]: r["tokens"]
        for r in parts.groupBy("source_key").agg(F.sum("tokens").alias("tokens")).collect()
    }
    given = {"" if s is None else f"={s}": w for s, w in (weights or {}).items()}
    robin = RoundRobin(
        tokens,
        {key: given.get(key, 1.0) if weights is not None else n for key, n in tokens.items()},
        window,
        least,
    )
    earlier = (
        Window.partitionBy("source_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = parts.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    bases = bases.drop("tokens")
    if parts.count() <= BROADCAST_PARTS:  # one for each source and task; else the ids move once
        bases = F.broadcast(bases)
    placed = made.join(bases, ["source_key", "part"]).select(
        "doc_id",
        "source_key",
        "ids",
        (F.col("base") + F.col("within")).cast("long").alias("first"),
    )
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = PIECES.replace("doc_id long", f"doc_id {doc_id}") + ", source_key string, ids binary"
    names = T._parse_datatype_string(schema).names
    dtype = encoder(vocabulary).dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "ids"):
                yield _cut(rows, robin, dtype, names)

    out = placed.mapInArrow(run, schema)
    named = F.when(F.col("source_key") != "", F.expr("substring(source_key, 2)"))
    return out.withColumn("source", named).drop("source_key")


def _cut(rows: pa.RecordBatch, robin: RoundRobin, dtype: np.dtype, names: list) -> pa.RecordBatch:
    ids = [np.frombuffer(b, dtype) for b in rows.column("ids").to_pylist()]
    n = np.array([len(one) for one in ids], np.int64)
    queue = np.array([robin.place[k] for k in rows.column("source_key").to_pylist()], np.int64)
    first = rows.column("first").to_numpy(zero_copy_only=False)
    row, start, length, number, offset = pieces_of(robin, queue, first, n)
    words = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
    low = (np.cumsum(n) - n)[row] + start
    # pieces are in the order of the words and leave none out
    ends = np.cumsum(length, dtype=np.int64)
    if len(ends) and (ends[-1] != len(words) or (low != ends - length).any()):
        raise AssertionError("pieces do not cover their documents")
    data = memoryview(words.tobytes())
    crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist())]
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
    blob = pa.BinaryArray.from_buffers(
        pa.binary(), len(row), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
    )
    take = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").take(take),
            pa.array(start),
            pa.array(length),
            pa.array(crc, pa.int64()),
            pa.array(n[row]),
            pa.array(number),
            pa.array(offset),
            rows.column("source_key").take(take),
            blob,
        ],
        names=names,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(common.documents(spark, sf_dir, "doc_id", "text", "source"))
    return packed.drop("ids", "source")
