"""Mixing sources to target weights by subset-sum budgets (operator 4).

Each source has a budget of words. Whole passes over the source use up most of it; what remains is
less than the source holds. Documents are counted by their exact length, and each length first
gives its share of the remaining budget. Then longest documents first, as far as they fit, and a
bounded knapsack over the counts that are left finds the sum nearest to the rest. A rest above its
size is brought below by several documents of a length, or by a very long one for shorter ones. The result is a
number of documents for each length of a source, and that many are chosen by a seeded hash.

Counts by length travel, never documents: a source of any size is a short table of lengths. Which
documents are chosen is settled by counts over 4,096 hash ranges of each length; only rows of the
one range where the number is reached are ranked.

A null text has no words. A null source is a source, the last. Documents without words are never
taken. Ties of the hash go to the lower doc_id, rows that agree in all are taken as their number
says. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.llm import common

SEED = 7_919
CYCLE = (1, 2, 3)  # fixed values: weights of the sources in order, repeating
WORD = r"[^\x20\x09-\x0D]+"
MOST_PASSES = 3
KNAPSACK = 1 << 16  # the rest that the knapsack takes on, in words
SHORT = 64  # documents up to this length are left to the knapsack
RANGES = 1 << 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets_of(sizes: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Budgets of (source, size): all words shared by weight, none above MOST_PASSES sizes.

    What is above goes to the others by weight, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: CYCLE[i % len(CYCLE)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    rest, open_, out = float(sum(size.values())), set(size), {}
    while open_:
        share = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > MOST_PASSES * size[s]}
        if not full:
            out |= {s: share * weight[s] for s in open_}
            break
        out |= {s: float(MOST_PASSES * size[s]) for s in full}
        rest -= sum(out[s] for s in full)
        open_ -= full
    return out


def nearest_sum(lengths: np.ndarray, counts: np.ndarray, rest: int) -> np.ndarray:
    """How many of each length to take, at most counts, so that the sum is nearest to ``rest``.

    Counts are split into 1, 2, 4... documents, so each part is taken or not. ``by`` keeps the part
    by which a sum was reached first; parts come in order, so a sum leads back through earlier ones.
    """
    taken = np.zeros(len(lengths), np.int64)
    top = 2 * rest
    parts = []
    for i in np.flatnonzero((counts > 0) & (lengths <= top)):
        left, many = min(int(counts[i]), top // int(lengths[i])), 1
        while left > 0:
            parts.append((int(i), min(many, left)))
            left, many = left - many, 2 * many
    by = np.full(top + 1, -1, np.int32)
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    for number, (i, many) in enumerate(parts):
        step = many * int(lengths[i])
        if step <= top:
            new = reached[: top + 1 - step] & ~reached[step:]
            by[step:][new] = number
            reached[step:] |= new
        if reached[rest]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        i, many = parts[by[at]]
        taken[i] += many
        at -= many * int(lengths[i])
    return taken


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take for a budget below what all of them hold."""
    total = int((lengths * counts).sum())
    if total <= 0 or budget <= 0:
        return np.zeros(len(lengths), np.int64)
    shares = [divmod(int(c) * budget, total) for c in counts]
    taken = np.array([whole for whole, _ in shares], np.int64)
    rest = budget - int((taken * lengths).sum())
    # one document more where the most of a share was cut, but leave the knapsack room to choose
    for i in np.argsort([-cut for _, cut in shares], kind="stable"):
        if rest <= KNAPSACK // 2:
            break
        if taken[i] < counts[i] and SHORT < lengths[i] <= rest - KNAPSACK // 4:
            taken[i] += 1
            rest -= int(lengths[i])
    if rest <= KNAPSACK:
        return taken + nearest_sum(lengths, counts - taken, rest)
    best, gap = taken, rest
    for tried, left in _near(lengths, counts, taken, rest):
        if 0 <= left <= KNAPSACK:
            tried = tried + nearest_sum(lengths, counts - tried, left)
        off = abs(budget - int((tried * lengths).sum()))
        if off < gap:
            best, gap = tried, off
        if gap < min(SHORT, lengths.min()):
            break
    return best


def _moved(
    lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, rest: int
) -> tuple[np.ndarray, int]:
    """``taken`` with more documents, or for a negative rest fewer, and the rest then.

    Several of a length, longest first, until about a quarter of KNAPSACK is left to choose in.
    """
    taken, aim = taken.copy(), KNAPSACK // 4
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        if rest > aim:
            many = min(int(counts[i] - taken[i]), (rest - aim) // length)
        elif rest < 0:
            many = -min(int(taken[i]), (aim - rest) // length)
        else:
            break
        taken[i] += many
        rest -= many * length
    return taken, rest


def _near(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, rest: int) -> Iterator[tuple]:
    """Ways to a rest that the knapsack takes on: several documents more, and where only very long
    ones are left, one of these for shorter ones, or one that is taken for others."""
    more, left = _moved(lengths, counts, taken, rest)
    yield more, left
    unit = np.eye(1, len(lengths), dtype=np.int64)[0]
    for i in np.argsort(np.abs(lengths - left), kind="stable"):
        if counts[i] > more[i]:
            one = more + np.roll(unit, i)
            yield one, left - int(lengths[i])
            yield _moved(lengths, counts, one, left - int(lengths[i]))
    for i in np.argsort(-lengths, kind="stable"):
        if more[i]:
            yield _moved(lengths, counts, more - np.roll(unit, i), left + int(lengths[i]))


def _fit_source(group: pd.DataFrame) -> pd.DataFrame:
    """The lengths of a source, with how many documents of each get a pass more."""
    group = group.sort_values("size", ignore_index=True)
    sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    total, target = int((sizes * counts).sum()), float(group["target"].iloc[0])
    passes = min(MOST_PASSES, int(target // total)) if total else 0
    budget = 0 if passes == MOST_PASSES else round(target - passes * total)
    chosen = np.zeros(len(group), np.int64)
    some = sizes > 0
    chosen[some] = (
        counts[some] if budget >= total else fit(sizes[some], counts[some], budget)
    )
    return group.assign(chosen=chosen, passes=passes)


_PLACE = ["source_key", "size", "range"]
_FITTED = "source_key string, size long, n long, target double, source_size long, chosen long, passes long"


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    return (
        docs.withColumn(
            "source_key",
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
        )
        .withColumn("size", word_count(F.col("text")))
        .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text"))
        .withColumn("range", F.shiftrightunsigned("draw", 64 - RANGES.bit_length() + 1))
        .withColumn("range", F.col("range").cast("int"))
    )


def mix(docs: DataFrame, payload: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """size, source_size, target and ``repeats`` (how often the mix has it) of every document
    (doc_id, text, source), with its columns ``payload``, as a struct of that name."""
    spark = docs.sparkSession
    columns = ["doc_id"] if payload is None else payload
    named = docs.select("doc_id", "text", "source", F.struct(*columns).alias("payload"))
    counts = common.settled(
        _placed(named.drop("payload"), seed).groupBy(*_PLACE).agg(F.count("*").alias("n")), "lengths"
    )
    by_length = counts.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    # one row for each source
    sizes = {
        r["source_key"]: r["words"]
        for r in by_length.groupBy("source_key")
        .agg(F.sum(F.col("size") * F.col("n")).alias("words"))
        .collect()
    }
    named_sizes = [(k[1:] if k else None, v) for k, v in sizes.items()]
    targets = [
        ("" if s is None else f"={s}", t, sizes["" if s is None else f"={s}"])
        for s, t in targets_of(named_sizes).items()
    ]
    budgets = spark.createDataFrame(targets, "source_key string, target double, source_size long")
    fitted = (
        by_length.join(budgets, "source_key")
        .groupBy("source_key")
        .applyInPandas(_fit_source, _FITTED)
        .drop("n")
    )
    earlier = (
        Window.partitionBy("source_key", "size")
        .orderBy("range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = F.col("chosen") - F.coalesce(F.sum("n").over(earlier), F.lit(0))
    quotas = counts.join(fitted, ["source_key", "size"]).withColumn("left", left)
    rank = F.row_number().over(Window.partitionBy(*_PLACE).orderBy("draw", "payload.doc_id"))
    chosen = _placed(named, seed).drop("text", "doc_id", "source").join(quotas, _PLACE)
    return chosen.select(
        "payload",
        "size",
        "source_size",
        "target",
        (F.col("passes") + (rank <= F.col("left")).cast("long")).alias("repeats"),
    )


def taken(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken of documents (doc_id, text, source)."""
    return mix(docs, seed=seed).select(
        F.col("payload.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("repeats")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as the mix has it, with all their columns."""
    repeats = F.array_repeat(F.lit(0), F.col("repeats").cast("int"))
    rows = mix(docs, docs.columns, seed).where("size > 0 AND repeats > 0")
    return rows.select("payload", F.explode(repeats)).select("payload.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(common.documents(spark, sf_dir, "doc_id", "text", "source"))
