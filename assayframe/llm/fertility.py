"""Quality rules on tokeniser fertility (operator 7).

A public vocabulary cuts text it knows into long pieces and anything else into scraps. Three
figures of a text say so: characters per token, the share of byte-fallback tokens (line ends and
tabs, which have no other form, aside), and the entropy of its tokens in bits. Each has a band for
every group and octave of length. A group is the language where it is a known one, else the script
that most letters have.

Bands come from all documents: the median of the distinct measurements, so that copies count once,
and so many robust deviations around it. An octave with few documents is pooled with its neighbours,
2, 4, 8 and then all octaves; a group with few documents has the bands of its script, a script with
few those of all documents, however few these are. So every document is judged on all three figures.
Plain counts of words, symbols and repeats come with the figures.

A null text is an empty one: it has no words and fails the base rule. A null language is an
unknown one. Repeated rows are each judged. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm import common, pieces

WINDOW = 8
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WIDTHS = (0, 1, 2, 3, 5)  # octaves are pooled by 1, 2, 4 and 8, then all 32
#: Languages with bands of their own; a bounded list, so that the table of bands is small.
LANGUAGES = tuple(
    "ar bg bn ca cs da de el en es et fa fi fr he hi hr hu id it ja ko lt lv ms nl no pl pt ro ru "
    "sk sl sr sv ta th tr uk ur vi zh".split()
)
SCRIPTS = tuple(
    "latin cyrillic greek arabic hebrew devanagari bengali tamil thai hangul hiragana katakana cjk "
    "other".split()
)
MEASURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"
    )]
    + [T.StructField(n, T.DoubleType()) for n in ("per_token", "byte_share", "entropy")]
    + [T.StructField("script", T.StringType())]
)


@dataclass(frozen=True)
class Bands:
    """Half widths of the bands: deviations, least deviation, and more for short texts."""

    deviations: float = 4.5
    least_per_token: float = 0.04
    least_entropy: float = 0.08
    short_tokens: float = 60.0  # widens each band by this many units over the number of tokens
    most_bytes: float = 0.20  # byte share that is let through above the group's median
    least_docs: int = 50


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that the text has twice or more."""
    n, number = len(words), {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    if n - len(number) < WINDOW:  # a second window has only words seen before
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    count = n - WINDOW + 1
    hashes = np.zeros(count, np.uint64)
    for k in range(WINDOW):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + count]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(count, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    edges[:count] += twice
    edges[WINDOW : WINDOW + count] -= twice
    return int(np.count_nonzero(np.cumsum(edges[:n])))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII separators only
    lines = [line for line in text.split("\n") if line.strip(SEPARATORS)]
    return (
        len(words),
        len(text) - sum(map(text.count, SEPARATORS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@lru_cache(maxsize=1 << 16)
def _script_of(letter: str) -> str:
    name = unicodedata.name(letter, "").split(" ")[0].lower()
    return name if name in SCRIPTS else "other"


def main_script(text: str) -> str:
    """The script of most letters; ties go to the first in the list of scripts."""
    if text.isascii():
        return "latin"
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes, counts = np.unique(letters, return_counts=True)
    found = dict.fromkeys(SCRIPTS, 0)
    for code, n in zip(codes.tolist(), counts.tolist(), strict=True):
        if (letter := chr(code)).isalpha():
            found[_script_of(letter)] += n
    return max(SCRIPTS, key=found.__getitem__)


@lru_cache(maxsize=2)
def _scraps(model_file: str) -> np.ndarray:
    """Which ids are byte fallbacks, of line ends and tabs aside."""
    sp = common.processor(model_file)
    scraps = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
    for code in (9, 10, 13):
        scraps[sp.piece_to_id(f"<0x{code:02X}>")] = False
    return scraps


def fertility(ids: np.ndarray, chars: int, scraps: np.ndarray) -> tuple[float, float, float]:
    """Characters per token, byte share and entropy of a text's tokens; zeros without tokens."""
    n = len(ids)
    if not n:
        return 0.0, 0.0, 0.0
    ordered = np.sort(ids)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    counts = np.diff(edges)
    entropy = np.log2(n) - float((counts * np.log2(counts)).sum()) / n
    return chars / n, float(scraps[ids].mean()), max(0.0, entropy)


def _measurer(model_file: str) -> Callable:
    table, scraps = pieces.id_table(model_file), _scraps(model_file)

    def measure(texts: list) -> list[pa.Array]:
        ids, sizes, _, _ = table.joined(texts)
        ends = np.cumsum(sizes).tolist()
        rows, begin = [], 0
        for text, end in zip(texts, ends, strict=True):
            own = fertility(ids[begin:end], len(text), scraps)
            rows.append((*base_counts(text), end - begin, *own, main_script(text)))
            begin = end
        kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()]
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

    return measure


def measured(docs: DataFrame, name: str, model_file: str | None = None) -> DataFrame:
    """``docs`` (text) with a struct ``name`` of MEASURES."""
    path = model_file or common.model_path()
    return common.map_texts(docs, partial(_measurer, path), MEASURES, name)


def group_of(lang: Column, script: Column) -> Column:
    return F.when(lang.isin(*LANGUAGES), lang).otherwise(F.concat(F.lit("script "), script))


def octave_of(n_tokens: Column) -> Column:
    return F.floor(F.log2(F.greatest(n_tokens, F.lit(1)))).cast("int")


def _wider(group: Column, script: Column) -> Column:
    """The pools of a document, narrowest first: its group, its script, all."""
    return F.array(group, F.concat(F.lit("any "), script), F.lit("all"))


def pools_of(measures: DataFrame, bands: Bands) -> DataFrame:
    """n and a struct ``band`` of limits of every figure for each pool, width and bin of octaves.

    At most as many rows as there are pools times octaves times widths, all fixed.
    """
    figures = ["per_token", "byte_share", "entropy"]
    pooled = measures.where("n_tokens > 0").select(
        F.explode(_wider(F.col("group"), F.col("script"))).alias("pool"), "octave", "n_tokens", *figures
    )
    once = pooled.dropDuplicates(["pool", "n_tokens", *figures])
    quarters = [F.percentile_approx(f, [0.25, 0.5, 0.75], 2000).alias(f) for f in figures]
    binned = once.select("*", F.explode(F.array(*map(F.lit, WIDTHS))).alias("width"))
    stats = (
        binned.withColumn("bin", F.expr("shiftright(octave, width)"))
        .groupBy("pool", "width", "bin")
        .agg(F.count("*").alias("n"), *quarters)
    )

    def half(figure: str, least: float) -> Column:
        spread = (F.col(figure)[2] - F.col(figure)[0]) / 1.349
        return bands.deviations * F.greatest(spread, F.lit(least))

    chars, entropy = half("per_token", bands.least_per_token), half("entropy", bands.least_entropy)
    limits = F.struct(
        (F.col("per_token")[1] - chars).alias("low_per_token"),
        (F.col("per_token")[1] + chars).alias("high_per_token"),
        (F.col("byte_share")[1] + bands.most_bytes).alias("high_bytes"),
        (F.col("entropy")[1] - entropy).alias("low_entropy"),
        (F.col("entropy")[1] + entropy).alias("high_entropy"),
    )
    return stats.select("pool", "width", "bin", "n", limits.alias("band"))


def bands_of(measures: DataFrame, bands: Bands) -> DataFrame:
    """A struct ``band`` for every group, script and octave: that of the narrowest pool with
    enough documents, at last that of all documents, however few."""
    asked = measures.select("group", "script", "octave").distinct()
    steps = (
        asked.select("*", F.posexplode(_wider(F.col("group"), F.col("script"))).alias("far", "pool"))
        .select("*", F.explode(F.array(*map(F.lit, WIDTHS))).alias("width"))
        .withColumn("bin", F.expr("shiftright(octave, width)"))
    )
    last = (F.col("pool") == "all") & (F.col("width") == WIDTHS[-1])
    found = steps.join(F.broadcast(pools_of(measures, bands)), ["pool", "width", "bin"])
    return (
        found.where((F.col("n") >= bands.least_docs) | last)
        .groupBy("group", "script", "octave")
        .agg(F.min_by("band", F.struct("far", "width")).alias("band"))
    )


def judged(docs: DataFrame, payload: list[str], bands: Bands | None = None) -> DataFrame:
    """A struct ``payload`` of the columns named, the measures ``m``, base_failed and kept of
    every document (text, lang)."""
    bands = bands or Bands()
    slim = docs.select(
        "text", F.col("lang").cast("string").alias("lang"), F.struct(*payload).alias("payload")
    )
    found = measured(slim, "m").select(
        "payload",
        "m",
        group_of(F.col("lang"), F.col("m.script")).alias("group"),
        octave_of(F.col("m.n_tokens")).alias("octave"),
    )
    found = common.settled(found, "measures")
    found = found.withColumn("script", F.col("m.script"))
    # one row for each known group, script and octave, see pools_of
    own = F.broadcast(bands_of(found.select("group", "octave", "m.*"), bands))
    banded = found.join(own, ["group", "script", "octave"], "left")
    m, own = F.col("m"), F.col("band")
    more = bands.short_tokens / F.greatest(m["n_tokens"], F.lit(1))
    inside = (
        m["per_token"].between(own["low_per_token"] - more, own["high_per_token"] + more)
        & m["entropy"].between(own["low_entropy"] - more, own["high_entropy"] + more)
        & (m["byte_share"] <= own["high_bytes"] + more / 10)
    )
    failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    return banded.select(
        "payload",
        "m",
        failed.alias("base_failed"),
        # without limits, where no text has tokens, all have failed
        (~failed & inside).alias("kept"),
    )


def rules(docs: DataFrame) -> DataFrame:
    """The base counts, figures and verdicts of documents (doc_id, text, lang)."""
    return judged(docs, ["doc_id"]).select(
        F.col("payload.doc_id").alias("doc_id"),
        *[f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        "kept",
        *[f"m.{c}" for c in ("n_tokens", "per_token", "byte_share", "entropy")],
    )


def kept_rows(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return judged(docs, docs.columns).where("kept").select("payload.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(common.documents(spark, sf_dir, "doc_id", "text", "lang"))
