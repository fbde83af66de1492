"""Arrow helpers shared by the operators that work on whole texts in Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.sources.tables import settle

PIECE_MODEL = "piece_bpe_32k.model"
SLICE_CHARS = 1_000_000  # bytes of text that a task turns into Python objects at a time
SPACE = r"\x20\x09-\x0d"  # fixed value: what separates words, for a regular expression class

#: Gets texts, returns a column of values for each field.
TextFunction = Callable[[list], Sequence[pa.Array]]


def model_path(name: str = PIECE_MODEL) -> str:
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def slices(batch: pa.RecordBatch, by: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose column ``by`` holds about ``limit`` bytes, at least one row each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(by)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    df: DataFrame,
    make: Callable[[], TextFunction],
    fields: T.StructType,
    name: str,
    text: str = "text",
) -> DataFrame:
    """``df`` and a struct column ``name``, computed from its texts (null: empty).

    ``make`` runs once in every task; what it returns is called with some texts at a time.
    The rows are neither moved nor reordered.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, text):
                texts = [x or "" for x in part.column(text).to_pylist()]
                made = pa.StructArray.from_arrays(list(compute(texts)), fields.fieldNames())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, made], names=[*part.schema.names, name]
                )

    return df.mapInArrow(run, schema)


def first_drawn(df: DataFrame, draw: F.Column, total: int, sample: int, *order) -> DataFrame:
    """At most ``sample`` of ``total`` rows: the first by ``draw``, a 64-bit hash, then ``order``.

    Rows that a slightly larger share of all hashes does not reach go before anything is sorted, so
    no task sorts or sends more than its part of the sample.
    """
    name = free_name(df, "_draw")
    drawn = df.withColumn(name, F.pmod(draw, F.lit(1 << 40)))
    share = 1.0 if total <= sample else min(1.0, (sample + 8 * sample**0.5 + 50) / total)
    kept = drawn.where(F.col(name) < int(share * (1 << 40)))
    return kept.orderBy(name, *order).limit(sample).drop(name)


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the folder that all executors share, and read back."""
    return settle(df, purpose)


@lru_cache(maxsize=4)
def processor(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def hex_digest(column) -> F.Column:
    return F.sha2(column, 256)
