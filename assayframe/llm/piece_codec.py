"""SentencePiece encoding and decoding by a distinct-chunk table (operator 6).

Each task keeps a table of the distinct marked words it has met; a word is segmented by the
library once, and ids are joined back by the words' positions. The table has a bounded size.
A table shared by the whole cluster would need every word occurrence to be shuffled to its entry
and back, several times the size of the texts; a task's own table moves nothing.

Null texts are empty texts; an empty text has the end id only and decodes to an empty text.
Repeated rows are each encoded. Other columns are passed on.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm import common, pieces

IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])


def _encoder(model_file: str, end: bool):
    table = pieces.id_table(model_file)
    last = common.processor(model_file).eos_id()

    def encode(texts: list) -> list[pa.Array]:
        ids, per_text, _, _ = table.joined(texts)
        if end:
            ids = np.insert(ids, np.cumsum(per_text), last)
            per_text = per_text + 1
        ids = pa.array(ids.astype(np.int32, copy=False))
        return [pa.ListArray.from_arrays(pieces.offsets(per_text), ids)]

    return encode


def encode(
    docs: DataFrame,
    *,
    text: str = "text",
    ids: str = "ids",
    end: bool = True,
    model_file: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of each whole text in the column ``ids``."""
    path = model_file or common.model_path()
    made = common.free_name(docs, "_encoded")
    out = common.map_texts(docs, partial(_encoder, path, end), IDS, made, text)
    return out.withColumn(ids, F.col(f"{made}.ids")).drop(made)


def decode_ids(flat: np.ndarray, counts: np.ndarray, model_file: str) -> list[str]:
    """Texts of consecutive id lists of counts[i] ids each."""
    data, starts, sizes = pieces.piece_bytes(model_file)
    out = data[pieces.spans(starts[flat], sizes[flat])].tobytes()
    ends = np.cumsum(pieces.sums(sizes[flat], counts))
    begins = np.concatenate([[0], ends[:-1]])
    cut = [out[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    # the marker that the model puts before a text is not part of it
    return [x[1:].decode(errors="replace") if x[:1] == b" " else x.decode(errors="replace") for x in cut]


def decode(
    encoded: DataFrame, *, ids: str = "ids", text: str = "decoded", model_file: str | None = None
) -> DataFrame:
    """``encoded`` with the text of its ids in the column ``text``. Null ids are no ids."""
    path = model_file or common.model_path()
    made = common.free_name(encoded, "_decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField(made, T.StringType())])

    def run(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                lists = batch.column(ids)
                counts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                if lists.null_count:
                    counts = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, counts)
                texts = decode_ids(flat, counts.astype(np.int64), path)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())],
                    names=[*batch.schema.names, made],
                )

    out = encoded.mapInArrow(run, schema)
    return out.withColumn(text, F.col(made)).drop(made)


CODED = T.StructType([*IDS.fields, T.StructField("decoded", T.StringType())])


def _coder(model_file: str):
    encoder = _encoder(model_file, True)

    def code(texts: list) -> list[pa.Array]:
        (ids,) = encoder(texts)
        counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
        flat = ids.values.to_numpy(zero_copy_only=False)
        return [ids, pa.array(decode_ids(flat, counts, model_file), pa.string())]

    return code


def round_trip(docs: DataFrame, name: str = "coded", model_file: str | None = None) -> DataFrame:
    """``docs`` (text) with a struct ``name`` of each text's ids, with the end id, and of what they
    decode to: ``encode`` and ``decode`` in one task, which spares a second Python worker."""
    path = model_file or common.model_path()
    return common.map_texts(docs, partial(_coder, path), CODED, name)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of documents (doc_id, text)."""
    ids = F.col("coded.ids")
    return round_trip(docs.select("doc_id", "text")).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        common.hex_digest(F.array_join(ids.cast("array<string>"), " ")).alias("ids_sha256"),
        common.hex_digest("coded.decoded").alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.documents(spark, sf_dir, "doc_id", "text"))
