"""Exact token counts of every prefix of every text (operator 3).

A BPE segmentation is the only one whose pieces stay whole when each piece, and each pair of
neighbours, is merged alone. So the last piece of a prefix is the one piece ending there that
encodes to itself and stands next to the last piece of the shorter prefix, and

    count[i] = count[i - length of the last piece] + 1.

The recurrence runs once for each distinct marked word of a task, in sorted order, so that words
share what their common prefixes have. A text's table is that of its words, each raised by the
tokens before it. Truncation and budget questions are answered from the table alone.

Null texts are empty texts: their table is [0]. Characters without a piece count as many tokens as
they have bytes. Repeated rows are each counted. Other columns are passed on.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm import common, pieces

LIMIT = 4096
FIELDS = T.StructType(
    [
        T.StructField("counts", T.ArrayType(T.IntegerType())),
        T.StructField("fits", T.LongType()),
    ]
)
KEPT_PAIRS = 1_000_000


class PrefixRecurrence:
    def __init__(self, model_file: str):
        self.sp = common.processor(model_file)
        sp = self.sp
        plain = [
            sp.id_to_piece(i)
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
        ]
        #: every ending of a piece; true for pieces that encode to themselves
        self.endings = {p[k:]: False for p in plain for k in range(len(p))}
        self.endings |= {p: parts == [p] for p, parts in zip(plain, self.alone(plain), strict=True)}
        self.neighbours: dict[str, dict[str, bool]] = {}
        self.pairs = 0

    def alone(self, strings: list[str]) -> list[list[str]]:
        """Pieces of strings as inside a text: behind a line end, with which nothing merges."""
        spaced = ["\n" + s.replace(pieces.MARK, " ") for s in strings]
        return [x[2:] for x in self.sp.encode(spaced, out_type=str, num_threads=1)]

    def _stay(self, left: str, right: str) -> bool:
        if self.pairs > KEPT_PAIRS:
            self.neighbours.clear()
            self.pairs = 0
        self.pairs += 1
        spaced = ("\n" + left + right).replace(pieces.MARK, " ")
        found = self.sp.encode(spaced, out_type=str)[2:] == [left, right]
        self.neighbours.setdefault(left, {})[right] = found
        return found

    def counts(self, words: list[str]) -> list[list[int]]:
        """For sorted marked words: the token counts of all their prefixes but the empty one."""
        out, before, none = [], "", {}
        count: list[int] = [0]
        last: list[str | None] = [None]
        endings, neighbours = self.endings, self.neighbours
        for word in words:
            chunk = pieces.MARK + word.replace(" ", pieces.MARK)
            same, most = 0, min(len(chunk), len(before))
            while same < most and chunk[same] == before[same]:
                same += 1
            del count[same + 1 :], last[same + 1 :]
            for end in range(same + 1, len(chunk) + 1):
                start, able = end - 1, []
                while start >= 0:
                    kind = endings.get(chunk[start:end])
                    if kind is None:
                        break
                    if kind:
                        able.append(start)
                    start -= 1
                for start in reversed(able):
                    left = last[start]
                    if left is not None:
                        piece = chunk[start:end]
                        stays = neighbours.get(left, none).get(piece)
                        if stays is None:
                            stays = self._stay(left, piece)
                        if not stays:
                            continue
                    count.append(count[start] + 1)
                    last.append(chunk[start:end])
                    break
                else:  # bytes, which no merge touches
                    count.append(count[end - 1] + len(chunk[end - 1].encode()))
                    last.append(None)
            out.append(count[1:])
            before = chunk
        return out


@lru_cache(maxsize=2)
def count_table(model_file: str) -> pieces.ChunkTable:
    pieces.check_marked(common.processor(model_file))
    return pieces.ChunkTable(PrefixRecurrence(model_file).counts)


def prefix_tables(table: pieces.ChunkTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the prefixes of 0, 1, 2... characters of each text, and each table's size."""
    values, per_text, sizes, words = table.joined(texts)
    whole = values[np.cumsum(sizes) - 1] if len(sizes) else values  # tokens of each word
    running = np.cumsum(whole, dtype=np.int64) - whole
    stops = np.cumsum(words)
    some = words > 0
    first = np.zeros(len(words), np.int64)
    first[some] = running[(stops - words)[some]]
    tables = values + np.repeat(running - np.repeat(first, words), sizes)
    starts = np.cumsum(per_text) - per_text
    tables[starts[some]] = 0  # the marker before a text is none of its characters
    return np.insert(tables, starts[~some], 0), np.where(some, per_text, 1)


def _counter(model_file: str, budget: int):
    table = count_table(model_file)

    def count(texts: list) -> list[pa.Array]:
        flat, sizes = prefix_tables(table, texts)
        ends = np.cumsum(sizes)
        # the longest prefix within the budget; counts may fall, so look from the end
        inside = np.flatnonzero(flat <= budget)
        fits = inside[np.searchsorted(inside, ends) - 1] - (ends - sizes)
        lists = pa.ListArray.from_arrays(pieces.offsets(sizes), pa.array(flat.astype(np.int32)))
        return [lists, pa.array(fits, pa.int64())]

    return count


def with_prefix_counts(
    docs: DataFrame, *, text: str = "text", budget: int = LIMIT, model_file: str | None = None
) -> DataFrame:
    """``docs`` with ``counts``, the table of the text (element i + 1: tokens of its first i
    characters), and ``fits``, the characters of its longest prefix within the budget."""
    path = model_file or common.model_path()
    made = common.free_name(docs, "_counted")
    out = common.map_texts(docs, partial(_counter, path, budget), FIELDS, made, text)
    return (
        out.withColumn("counts", F.col(f"{made}.counts"))
        .withColumn("fits", F.col(f"{made}.fits"))
        .drop(made)
    )


def tokens_of_prefix(counts: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` characters, from a text's table."""
    return F.element_at(counts, F.least(chars.cast("int"), F.size(counts) - 1) + 1)


def longest_within(counts: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from a text's table."""
    places = F.sequence(F.size(counts), F.lit(1), F.lit(-1))
    return F.element_at(F.filter(places, lambda i: F.element_at(counts, i) <= budget), 1) - 1


def token_counts(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and limit_chars of documents (doc_id, text)."""
    n_tokens = tokens_of_prefix(F.col("counts"), F.lit(2**31 - 1)).cast("long")
    return with_prefix_counts(docs.select("doc_id", "text"), budget=limit).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        n_tokens.alias("n_tokens"),
        (n_tokens > limit).alias("over_limit"),
        F.col("fits").alias("limit_chars"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.documents(spark, sf_dir, "doc_id", "text"))
