"""The incremental job over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.operators import mwtab
from assayframe.session import shared_folder
from assayframe.streaming import incremental
from bindings.core import bound
from bindings.matrices import PLAIN, STRICT, V, _grid, _typed_text


def _rows(layout: mwtab.Layout, labels: dict[int, str], test: str) -> str:
    return f"""SELECT * FROM (WITH {_grid(layout, labels)}
      SELECT 'F' || doc_id AS file_id, CAST(line_no AS INTEGER) AS line_no,
        c AS col_index, '{layout.name}' AS layout, {V} AS value FROM g WHERE {test})"""


@bound(
    "incremental_ingest",
    _rows(mwtab.PLAIN, PLAIN, "doc_id % 4 = 0")
    + " UNION ALL "
    + _rows(mwtab.MS, STRICT, "doc_id % 4 = 1")
    + " UNION ALL "
    + _rows(mwtab.NMR, STRICT, "doc_id % 4 = 2"),
)
def incremental_ingest(spark, sf_dir):
    """Stream the documents as files into a parsed table; the second run adds nothing."""
    folder = shared_folder(spark, "incremental")
    path = f"{sf_dir}/documents.parquet"
    schema = spark.read.parquet(path).schema
    for _ in range(2):
        # a pattern matches a table that is one file as well as one that is a folder
        documents = spark.readStream.schema(schema).parquet(f"{path}*")
        files = documents.select(
            F.format_string("F%d", "doc_id").alias("file_id"), _typed_text().alias("content")
        )
        query = incremental.append_available(
            incremental.parsed_stream(files), f"{folder}/cells", f"{folder}/log"
        )
        query.awaitTermination()
    cells = spark.read.parquet(f"{folder}/cells")
    return cells.select("file_id", "line_no", "col_index", "layout", "value")
