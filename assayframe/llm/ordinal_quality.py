"""Ordinal regression on graded ratings (operator 8).

Grades are ordered. One weight vector over hashed text features is shared by all of them, and
ordered thresholds cut the score: P(grade >= k) = sigmoid(score - threshold[k]). From that follow
the expected grade and the tail probabilities by which documents are selected.

Features are the presence of hashed words, of the signs that words carry besides letters, and of
steps of three shares (repeated, upper-case and short words). 2**24 places keep an unseen word from
meeting a heavy weight. The model is fitted on at most SAMPLE labelled documents, the first by a
hash of their ids; scoring covers all documents. Only features of MIN_DOCS sampled documents get
weights, so the model has a bounded size and goes to the tasks as a table.

A null text is an empty one and has no word features. Null ratings are not used; a document rated
more than once has its lowest grade. Without ratings every document has the same score and is kept.
Repeated rows are each scored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm import common

PLACES = 1 << 24
SAMPLE = 16_000
MIN_DOCS = 4
KEPT_WORDS = 400_000
ROUNDS, RATE, DECAY = 300, 0.1, 3e-4
KEEP_TAIL = 0.3  # least probability of the best grade for a document to be kept
_SIGNS = re.compile(r"[\w\s]+")


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 of low quality, 2 good."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


class Hasher:
    """Feature places of texts, with a table of the words met so far (bounded)."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def _places(self, word: str) -> tuple[int, ...]:
        bare = word.strip(".,;:!?\"'()").lower()
        signs = _SIGNS.sub("", word)
        names = [f"w {bare}"] if bare else []
        names += [f"s {signs}"] if signs not in ("", ".", ",") else []
        return tuple(xxhash.xxh64_intdigest(n) % PLACES for n in names)

    def features(self, text: str) -> list[int]:
        words = text.split()
        distinct = set(words)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known, places = self.known, set()
        for word in distinct:
            found = known.get(word)
            if found is None:
                found = known[word] = self._places(word)
            places.update(found)
        if words:
            n = len(words)
            shares = {
                "repeat": round(8 * (1 - len(distinct) / n)) if n >= 40 else 0,
                "upper": 8 * sum(w.isupper() for w in distinct) // len(distinct),
                "next": 8 * sum(map(str.__eq__, words, words[1:])) // n,
            }
            places.update(
                xxhash.xxh64_intdigest(f"{k} {v}") % PLACES for k, v in shares.items() if v
            )
        return sorted(places)


def _hasher_function():
    hasher = Hasher()

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array([hasher.features(t) for t in texts], pa.list_(pa.int32()))]

    return compute


FEATURES = T.StructType([T.StructField("places", T.ArrayType(T.IntegerType()))])


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of feature places and the ordered thresholds, one less than there are grades."""

    places: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2..., a row for each score."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def fit(places: list[np.ndarray], grades: np.ndarray, n_grades: int = 3) -> OrdinalModel:
    """The model of documents with the given feature places and grades."""
    sizes = np.array([len(p) for p in places], np.int64)
    flat = np.concatenate([*places, np.zeros(0, np.int64)])
    return fit_flat(flat, sizes, grades, n_grades)


def fit_flat(
    flat: np.ndarray, sizes: np.ndarray, grades: np.ndarray, n_grades: int = 3
) -> OrdinalModel:
    """Maximum likelihood of the cumulative logits with a ridge, by Adam on all rows.

    ``flat`` has the places of one document after the other, ``sizes`` of them each. Thresholds
    are the first and positive steps from it, so they stay in order.
    """
    if not len(grades):
        none = np.zeros(0)
        return OrdinalModel(none.astype(np.int64), none, np.full(n_grades - 1, -5.0))
    used, counts = np.unique(flat, return_counts=True)
    used = used[counts >= MIN_DOCS]
    inside = np.isin(flat, used)
    rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[inside]
    at = np.searchsorted(used, flat[inside]).astype(np.int32)
    n, d = len(grades), len(used)
    value = np.zeros(d + n_grades - 1)
    share = np.array([np.clip(np.mean(grades >= k), 0.01, 0.99) for k in range(1, n_grades)])
    start = -np.log(share / (1 - share))
    value[d] = start[0]
    value[d + 1 :] = np.log(np.maximum(np.diff(start), 0.1))
    first, second = np.zeros_like(value), np.zeros_like(value)
    above = (grades[:, None] >= np.arange(1, n_grades)[None, :]).astype(float)
    edge = np.zeros((n, 1))
    for step in range(1, ROUNDS + 1):
        weights, cuts = value[:d], _cuts(value[d:])
        scores = np.bincount(rows, weights[at], n)
        tail = 1 / (1 + np.exp(-np.clip(scores[:, None] - cuts[None, :], -40, 40)))
        full = np.hstack([edge + 1, tail, edge])
        chance = full[np.arange(n), grades] - full[np.arange(n), grades + 1]
        # d log chance / d tail_k is +1 at the grade's lower edge and -1 at its upper one
        sign = (above - np.hstack([above[:, 1:], edge])) - (
            np.hstack([edge + 1, above[:, :-1]]) - above
        )
        slope = sign * tail * (1 - tail) / np.maximum(chance, 1e-9)[:, None]
        by_score = slope.sum(1) / n
        gradient = np.empty_like(value)
        gradient[:d] = np.bincount(at, by_score[rows], d) - DECAY * weights
        by_cut = -slope.sum(0) / n
        gradient[d] = by_cut.sum()
        for j in range(1, n_grades - 1):
            gradient[d + j] = by_cut[j:].sum() * np.exp(value[d + j])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        value = value + RATE * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
    return OrdinalModel(used, value[:d], _cuts(value[d:]))


def _cuts(free: np.ndarray) -> np.ndarray:
    return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def training_rows(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """places and grade of at most ``sample`` rated documents of (doc_id, text)."""
    rated = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL")
    graded = rated.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    draw = F.xxhash64(F.lit("rated"), "doc_id")
    chosen = common.first_drawn(graded, draw, graded.count(), sample, "doc_id")
    # no more than ``sample`` rows of two numbers
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    once = joined.dropDuplicates(["doc_id"])
    made = common.map_texts(once, _hasher_function, FEATURES, "_made")
    return made.select("doc_id", "grade", F.col("_made.places").alias("places"))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    found = training_rows(docs, ratings, sample).toArrow().sort_by("doc_id").combine_chunks()
    places = found["places"].combine_chunks() if found.num_rows else None
    if places is None:
        return fit([], np.zeros(0, np.int64))
    flat = places.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(places).to_numpy(zero_copy_only=False)
    return fit_flat(flat, sizes, found["grade"].to_numpy().astype(np.int64))


def scored(docs: DataFrame, model: OrdinalModel, name: str) -> DataFrame:
    """``docs`` (text) with a struct ``name``: score, expected grade and tail probabilities."""
    n = len(model.thresholds)
    fields = T.StructType(
        [T.StructField("score", T.DoubleType()), T.StructField("expected_grade", T.DoubleType())]
        + [T.StructField(f"p_{k}", T.DoubleType()) for k in range(1, n + 1)]
    )
    table = dict(zip(model.places.tolist(), model.weights.tolist(), strict=True))

    def make():
        hasher = Hasher()

        def compute(texts: list) -> list[pa.Array]:
            scores = np.array(
                [sum(table.get(p, 0.0) for p in hasher.features(t)) for t in texts], float
            )
            tails = model.tails(scores)
            return [pa.array(scores), pa.array(tails.sum(1)), *(pa.array(t) for t in tails.T)]

        return compute

    return common.map_texts(docs, make, fields, name)


def select_documents(docs: DataFrame, ratings: DataFrame, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """doc_id, expected_grade, the tails and ``kept`` of documents (doc_id, text).

    ``ratings`` has doc_id and grade (0, 1, 2).
    """
    slim = docs.select("doc_id", "text")
    model = train(slim, ratings)
    return scored(slim, model, "_s").select(
        "doc_id",
        F.round("_s.expected_grade", 6).alias("expected_grade"),
        F.round("_s.p_1", 6).alias("p_low_or_better"),
        F.round("_s.p_2", 6).alias("p_good"),
        (F.col("_s.p_2") >= keep_tail).alias("kept"),
    )


def ratings_of(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", grade_of(F.col("quality"), F.col("toxic")).alias("grade"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return select_documents(common.documents(spark, sf_dir, "doc_id", "text"), ratings_of(labels))
