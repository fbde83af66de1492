"""Personal data by weak supervision (operator 2).

Candidates of four kinds come from each whole text: what the base patterns match, whether or not it
passes their checks, and looser forms (bracketed "at" addresses, phone numbers without a plus).
Labelers vote yes, no or nothing on each one: patterns, gazetteers (top-level domains, card issuers,
calling codes, reserved networks), checks of digits, the words before it and what touches it.
Expectation-maximisation estimates from the counts of all vote patterns how far each labeler can be
relied on, per kind, and how likely each pattern is personal data. A logistic span classifier learns
these probabilities from the votes, the shape and the words around a span.

All candidates count in the estimate: the driver gets a count for each kind and vote pattern, which
are bounded. The classifier is fitted on at most SAMPLE candidates, the first by a hash of their
document and place. The result is the base spans, all of them, and every other candidate that the
classifier is sure of and that overlaps no base span.

Offsets are code points, ends exclusive. A null text is an empty one and has no spans. Repeated rows
have the same spans each. An empty table gives an empty result, and a table without candidates the
base spans only, of which there are none.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm import common

KINDS = ("email", "ip", "card", "phone")
# The base patterns, and what a run of a number is made of.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMBERS = {
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # holds the matches of ip, four groups of digits each
DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"[+0-9\x20().-]+")
LOOSE_PHONE = re.compile(r"\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
LOOSE_EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,64}"
    r"(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[A-Za-z0-9-]{1,64}){1,8}",
    re.IGNORECASE,
)
# The gazetteers.
TOP_DOMAINS = frozenset(
    "ai app at au be biz br ca ch cn co com cz de dev dk edu es eu fi fr gov gr hu ie il in info int "
    "io it jp kr me mil mx net nl no nz org pl pt ro ru se sg sk tr tv tw ua uk us za".split()
)
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 "
    "64 65 66 81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 355 356 357 358 359 370 371 372 380 "
    "385 386 420 421 852 886 966 971 972".split()
)
CUES = {
    "email": ("mail", "contact", "write", "kontakt", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "adresse", "login", "client"),
    "card": ("card", "visa", "mastercard", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}
NOT_CUES = ("token", "hash", "version", "isbn", "order", "invoice", "sha", "doi", "price", "page")
LABELERS = ("pattern", "shape", "gazetteer", "check", "context", "edges")
SAMPLE = 20_000
SURE = 0.9
PLACES = 1 << 14
_BEFORE = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes(kind: str, span: str) -> bool:
    """The checks of a base match."""
    if kind == "ip":
        parts = [p.lstrip("0") for p in span.split(".")]
        return all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts)
    digits = digits_of(span)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the base pattern: an address begins where the run before its @ does."""
    ended = 0
    if "@" not in text:
        return
    for match in DOMAIN.finditer(text):
        start = match.start()
        while start > ended and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            ended = match.end()
            yield start, ended


def addresses(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Matches of ip: groups of digits between single dots, by fours from the left."""
    for match in DOTTED.finditer(text, start, end):
        groups = match.group().split(".")
        at = match.start()
        for i in range(0, len(groups) - 3, 4):
            size = sum(map(len, groups[i : i + 4])) + 3
            yield at, at + size
            at += size + 1


class Held:
    """Intervals, and whether any of them overlaps another one."""

    def __init__(self, intervals: Iterable[tuple[int, int]]):
        known = sorted(intervals)
        self.starts = [a for a, _ in known]
        self.reach = list(accumulate((b for _, b in known), max))
        self.added: list[tuple[int, int]] = []  # in order; none overlaps any other

    def overlaps(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        if before and self.reach[before - 1] > start:
            return True
        before = bisect_left(self.added, (end,))
        return before > 0 and self.added[before - 1][1] > start

    def add(self, start: int, end: int) -> None:
        insort(self.added, (start, end))


def number_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs that hold all matches of the number patterns; no match reaches over a run's end."""
    at = 0
    while found := DIGIT.search(text, at):
        start = found.start()
        if start > at and text[start - 1] in "+(":
            start -= 1
        at = RUN.match(text, start).end()
        yield start, at


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all candidates, base spans and others."""
    out = [("email", a, b, True) for a, b in emails(text)]
    if "at" in text or "AT" in text or "At" in text:
        if "[" in text or "(" in text:
            out += [("email", *m.span(), False) for m in LOOSE_EMAIL.finditer(text)]
    for start, end in number_runs(text):
        if end - start < 7:
            continue
        found = [("ip", a, b, passes("ip", text[a:b])) for a, b in addresses(text, start, end)]
        for kind, pattern in NUMBERS.items():
            for match in pattern.finditer(text, start, end):
                span = match.group()
                base = passes(kind, span)
                if base or kind != "card" or len(digits_of(span)) >= 13:
                    found.append((kind, *match.span(), base))
        taken = Held((a, b) for _, a, b, _ in found)
        for match in LOOSE_PHONE.finditer(text, start, end):
            if not taken.overlaps(*match.span()):
                found.append(("phone", *match.span(), False))
        out += found
    return out


def _vote(yes: bool, no: bool = False) -> str:
    return "+" if yes else "-" if no else "0"


def votes(text: str, kind: str, start: int, end: int, base: bool) -> str:
    """A sign for each of LABELERS: + yes, - no, 0 nothing."""
    span = text[start:end]
    digits = digits_of(span)
    before = text[max(0, start - 40) : start].lower()
    words = _BEFORE.findall(before)[-4:]
    cue = any(w.startswith(CUES[kind]) for w in words)
    against = any(w.startswith(NOT_CUES) for w in words)
    touched = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    if kind == "email":
        last = re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]"))[-1].lower()
        shape = _vote("@" in span and not span.startswith((".", "-")), span.startswith("."))
        known, check = _vote(last in TOP_DOMAINS, last.isdigit()), _vote(len(span) <= 254, True)
    elif kind == "ip":
        parts = span.split(".")
        plain = all(p == "0" or not p.startswith("0") for p in parts)
        shape = _vote(plain, not plain)
        reserved = parts[0] in ("0", "255") or len(parts[0]) > 3
        known, check = _vote(not reserved, reserved), _vote(base, not base)
    elif kind == "card":
        groups = re.split(r"[\x20-]", span)
        even = len(groups) == 1 or all(len(g) == 4 for g in groups[:-1])
        shape = _vote(even and 15 <= len(digits) <= 16, not even)
        known = _vote(digits[0] in "3456", digits[0] in "01789")
        valid = luhn(digits)
        check = _vote(valid, not valid)
    else:
        grouped = bool(re.search(r"[\x20().-]", span))
        shape = _vote(grouped and "  " not in span, "  " in span)
        coded = any(digits.startswith(c) for c in (digits[:1], digits[:2], digits[:3]) if c in CALLING_CODES)
        known = _vote(span.startswith("+") and coded, span.startswith("+") and not coded)
        check = _vote(10 <= len(digits) <= 13, not 8 <= len(digits) <= 15)
    return _vote(base) + shape + known + check + _vote(cue, against) + _vote(False, touched)


def features(text: str, kind: str, start: int, end: int, signs: str) -> list[int]:
    """Hashed features of a span: its votes, shape and the words around it."""
    span = text[start:end]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "9", span)))[:24]
    left = _BEFORE.findall(text[max(0, start - 24) : start].lower())[-2:]
    right = _BEFORE.findall(text[end : end + 24].lower())[:1]
    names = [f"{i}{s}" for i, s in enumerate(signs)] + [f"shape {shape}", f"size {end - start}"]
    names += [f"left {w}" for w in left] + [f"right {w}" for w in right] + ["kind"]
    return sorted({xxhash.xxh64_intdigest(f"{kind} {n}") % PLACES for n in names})


# ---------------------------------------------------------------- estimates


def reliabilities(
    counts: dict[str, int], rounds: int = 50
) -> tuple[dict[str, float], np.ndarray]:
    """From counts of vote patterns of one kind: each pattern's chance to be personal data, and
    P(vote | class) as an array (class, labeler, vote)."""
    patterns = sorted(counts)
    if not patterns:
        return {}, np.full((2, len(LABELERS), 3), 1 / 3)
    weight = np.array([counts[p] for p in patterns], float)
    given = np.array([["+0-".index(c) for c in p] for p in patterns])
    seen = np.eye(3)[given]  # pattern, labeler, vote
    balance = (given == 0).sum(1) - (given == 2).sum(1)
    chance = 1 / (1 + np.exp(-1.5 * balance.astype(float)))
    for _ in range(rounds):
        likely = []
        for share in (1 - chance, chance):
            total = np.einsum("p,plv->lv", weight * share, seen) + 0.5
            likely.append(total / total.sum(1, keepdims=True))
        prior = (weight @ chance + 1) / (weight.sum() + 2)
        scores = [np.einsum("plv,lv->p", seen, np.log(t)) for t in likely]
        odds = np.log(prior / (1 - prior)) + scores[1] - scores[0]
        chance = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(patterns, chance.tolist(), strict=True)), np.array(likely)


@dataclass(frozen=True)
class SpanModel:
    """Weights by feature place; scores of a kind without candidates are 0."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(PLACES))
    chances: dict = field(default_factory=dict)  # kind: pattern: chance

    def probability(self, places: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[places].sum(), -30, 30))))


def fit_classifier(places: list[list[int]], chances: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Logistic regression on soft labels with a ridge, by Adam on all rows."""
    weights = np.zeros(PLACES)
    if not places:
        return weights
    rows = np.repeat(np.arange(len(places)), [len(p) for p in places])
    flat = np.concatenate([np.asarray(p, np.int64) for p in places])
    first, second = np.zeros(PLACES), np.zeros(PLACES)
    for step in range(1, rounds + 1):
        scores = np.bincount(rows, weights[flat], len(places))
        error = chances - 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
        gradient = np.bincount(flat, error[rows], PLACES) / len(places) - 1e-4 * weights
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        weights = weights + 0.1 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
    return weights


VOTED = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("signs", T.StringType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
        ]
    )
)
_VOTED = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("signs", pa.string()), ("places", pa.list_(pa.int32()))]
    )
)


def _voting_function():
    def compute(texts: list) -> list[pa.Array]:
        out = []
        for text in texts:
            rows = []
            for kind, start, end, base in candidates(text):
                signs = votes(text, kind, start, end, base)
                rows.append((kind, start, signs, features(text, kind, start, end, signs)))
            out.append([dict(zip(("kind", "start", "signs", "places"), r, strict=True)) for r in rows])
        return [pa.array(out, _VOTED)]

    return compute


def train(docs: DataFrame, sample: int = SAMPLE) -> SpanModel:
    """The model of the candidates of all documents (doc_id, text)."""
    slim = docs.select("doc_id", "text")
    voted = common.map_texts(slim, _voting_function, T.StructType([T.StructField("c", VOTED)]), "v")
    rows = voted.select("doc_id", F.explode("v.c").alias("c")).select("doc_id", "c.*")
    rows = common.settled(rows, "votes")
    counts: dict[str, dict[str, int]] = {k: {} for k in KINDS}
    for r in rows.groupBy("kind", "signs").agg(F.count("*").alias("n")).collect():
        counts[r["kind"]][r["signs"]] = r["n"]
    chances = {k: reliabilities(c)[0] for k, c in counts.items()}
    draw = F.xxhash64(F.lit("sample"), "doc_id", "kind", "start")
    total = sum(sum(c.values()) for c in counts.values())
    chosen = common.first_drawn(rows, draw, total, sample, "kind", "signs").collect()
    target = np.array([chances[r["kind"]][r["signs"]] for r in chosen])
    return SpanModel(fit_classifier([r["places"] for r in chosen], target), chances)


# ---------------------------------------------------------------- spans

SPANS = T.StructType(
    [
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                        T.StructField("base", T.BooleanType()),
                        T.StructField("probability", T.DoubleType()),
                    ]
                )
            ),
        )
    ]
)
_SPANS = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("base", pa.bool_()),
            ("probability", pa.float64()),
        ]
    )
)


def spans_of(text: str, model: SpanModel, sure: float = SURE) -> list[tuple]:
    """(kind, start, end, base, probability) of a text, by kind and then start."""
    found, kept = candidates(text), []
    held = Held((a, b) for _, a, b, base in found if base)
    for kind, start, end, base in found:
        signs = votes(text, kind, start, end, base)
        chance = model.probability(features(text, kind, start, end, signs))
        if not base:
            if chance < sure or held.overlaps(start, end):
                continue
            held.add(start, end)
        kept.append((kind, start, end, base, round(chance, 6)))
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1]))


def with_spans(docs: DataFrame, model: SpanModel, name: str = "spans") -> DataFrame:
    """``docs`` (text) with the column ``name``: all spans of each whole text."""

    def make(known: SpanModel):
        names = [f.name for f in SPANS["spans"].dataType.elementType]

        def compute(texts: list) -> list[pa.Array]:
            rows = [[dict(zip(names, s, strict=True)) for s in spans_of(t, known)] for t in texts]
            return [pa.array(rows, _SPANS)]

        return compute

    made = common.free_name(docs, "_spans")
    out = common.map_texts(docs, partial(make, model), SPANS, made)
    return out.withColumn(name, F.col(f"{made}.spans")).drop(made)


def masked(text: str, spans: list) -> str:
    """A text with each span replaced by its kind in brackets; overlapping spans are one."""
    out, at, open_end = [], 0, 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= open_end:
            out += [text[at : span["start"]], f"[{span['kind'].upper()}]"]
        open_end = at = max(open_end, span["end"])
    return "".join([*out, text[at:]])


MASKED = T.StructType([T.StructField("text", T.StringType())])


def mask_rows(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked, with all their columns; n_chars follows."""
    model = train(docs)
    names = ("kind", "start", "end", "base", "probability")

    def make():
        def compute(texts: list) -> list[pa.Array]:
            out = []
            for text in texts:
                spans = [dict(zip(names, s, strict=True)) for s in spans_of(text, model)]
                out.append(masked(text, spans) if spans else text)
            return [pa.array(out, pa.string())]

        return compute

    made = common.free_name(docs, "_masked")
    text = F.when(F.col("text").isNotNull(), F.col(f"{made}.text"))
    out = common.map_texts(docs, make, MASKED, made).withColumn("text", text).drop(made)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _listed(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def found(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and spans of documents (doc_id, text)."""
    slim = docs.select("doc_id", "text")
    base = F.filter("spans", lambda s: s["base"])
    counts = [_count(base, kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return with_spans(slim, train(slim)).select(
        "doc_id",
        *counts,
        common.hex_digest(_listed(base)).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(common.documents(spark, sf_dir, "doc_id", "text"))
