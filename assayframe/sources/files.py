"""Reading directories: listing, fingerprints, texts, lines.

Directories are listed in tasks, so every file is seen: also those without bytes and those whose
name, or whose folder's name, begins with "_" or "." (Spark's own file index hides these).
"""

from __future__ import annotations

import hashlib
import os
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.functions.filetypes import (
    EXTENSIONS,
    HTML_MARKER,
    MWTAB_MARKER,
    detected_type,
    extension_of,
    filename_of,
    is_allowed_extension,
)
from assayframe.functions.keys import row_id
from assayframe.functions.text import drop_bad_utf8, without_mark
from assayframe.operators.mwtab import layout_of_lines
from assayframe.sources.places import place
from assayframe.sources.tables import settle

STREAM_CHUNK = 8 * 1024 * 1024
RANGE_BYTES = 64 * 1024 * 1024  # of a large file that a task reads line by line
READ_BYTES = 64 * 1024 * 1024  # of whole files that a task reads, on average
READ_FILES = 10_000  # that a task opens, on average
MOST_TASKS = 100_000
ROW_BYTES = 1 << 30  # files beyond this are not loaded into one row
MOST_IN_ROW = (1 << 31) - 1  # bytes, whatever a caller asks for
LISTED = "path string, size_bytes long, is_folder boolean, hidden boolean"


def plain_path(path: Column) -> Column:
    """Local files without their scheme; other file systems keep the full URI."""
    return F.regexp_replace(path, "^file:/+", "/")


def path_of_uri(uri: Column) -> Column:
    """Path of a percent-encoded URI (a plus sign is a plus sign there)."""
    return plain_path(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def _is_hidden(path: str) -> bool:
    return path.rpartition("/")[2].startswith(("_", "."))


def _children(path: str, hidden: bool) -> Iterator[tuple[str, int | None, bool, bool]]:
    """(path, bytes, is folder, hidden) of a file, or of what a folder holds itself.

    The size is null where a file is named but cannot be found, as behind a broken link.
    """
    system, inside, before = place(path)
    if not before and os.path.isdir(inside):
        yield from _local_children(inside, hidden)
        return
    found = system.get_file_info([inside])[0]
    if found.type == FileType.File:
        yield path, found.size, False, hidden or _is_hidden(path)
    if found.type != FileType.Directory:
        return
    for entry in system.get_file_info(FileSelector(inside)):
        folder = entry.type == FileType.Directory
        size = entry.size if entry.type == FileType.File else None
        yield before + entry.path, size, folder, hidden or _is_hidden(entry.path)


def _local_children(folder: str, hidden: bool) -> Iterator[tuple]:
    """As ``_children`` of a local folder, broken links included."""
    with os.scandir(folder) as entries:
        for entry in entries:
            hides = hidden or _is_hidden(entry.path)
            if entry.is_dir(follow_symlinks=False):
                yield entry.path, None, True, hides
            elif not entry.is_dir():
                try:
                    size = entry.stat().st_size
                except OSError:
                    size = None
                yield entry.path, size, False, hides


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(rows: list[tuple]) -> pd.DataFrame:
        listed = pd.DataFrame(rows, columns=["path", "size_bytes", "is_folder", "hidden"])
        return listed.astype({"size_bytes": "Int64"})

    for batch in batches:
        for path, hidden in zip(batch["path"], batch["hidden"], strict=True):
            rows: list[tuple] = []
            for row in _children(path, hidden):
                rows.append(row)
                if len(rows) == 10_000:
                    yield frame(rows)
                    rows = []
            if rows:
                yield frame(rows)


def listing(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(path, size_bytes, hidden) of all files below ``root``, listed in tasks and stored.

    Level by level: the folders of a level are spread over tasks, whatever folder they came from, and
    what they hold is stored before the next level begins. A tree takes as many jobs as it is deep.
    Hidden are files whose name, or a folder of theirs below the root, begins with "_" or ".".
    """
    roots = [root] if isinstance(root, str) else list(root)
    start = [(r.rstrip("/") or "/", False) for r in roots]
    level = spark.createDataFrame(start, "path string, hidden boolean").coalesce(1)
    tasks = 4 * spark.sparkContext.defaultParallelism
    levels: list[DataFrame] = []
    while True:
        levels.append(settle(level.mapInPandas(_list, LISTED), "listed"))
        folders = levels[-1].where("is_folder").select("path", "hidden")
        if folders.isEmpty():
            break
        level = folders.repartition(tasks, "path")
    files = [found.where("NOT is_folder").select("path", "size_bytes", "hidden") for found in levels]
    return reduce(DataFrame.unionByName, files)


def list_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """All files below ``root``; contents are not read. A null size means a file that is named
    there but cannot be found."""
    return described(listing(spark, root))


def described(listed: DataFrame) -> DataFrame:
    name = filename_of(F.col("path"))
    return listed.select(
        F.col("path").alias("path_abs"),
        name.alias("filename"),
        extension_of(name).alias("ext"),
        "size_bytes",
        *[c for c in listed.columns if c == "content"],
    )


def _with_content(rows: pa.RecordBatch, contents: list[pa.Buffer]) -> pa.RecordBatch:
    """``rows`` with the bytes of their files; those of a file that stands alone are not copied."""
    sizes = np.array([0, *(len(c) for c in contents)], np.int64)
    data = contents[0] if len(contents) == 1 else pa.py_buffer(b"".join(contents))
    offsets = pa.py_buffer(np.cumsum(sizes).astype(np.int32).tobytes())
    binary = pa.BinaryArray.from_buffers(pa.binary(), len(contents), [None, offsets, data])
    return pa.RecordBatch.from_arrays([*rows.columns, binary], names=[*rows.schema.names, "content"])


def _read_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column is a path, with the contents of the files, up to STREAM_CHUNK at a time
    and larger files alone; those that cannot be read are left out."""
    for batch in batches:
        places: list[int] = []
        contents: list[pa.Buffer] = []
        held = 0
        for i, path in enumerate(batch.column(0).to_pylist()):
            system, inside, _ = place(path)
            try:
                with system.open_input_stream(inside) as stream:
                    content = stream.read_buffer()
            except OSError:
                continue
            if len(content) > MOST_IN_ROW:
                raise ValueError(f"{path} has {len(content)} bytes, more than a row holds")
            if contents and held + len(content) > STREAM_CHUNK:
                yield _with_content(batch.take(pa.array(places)), contents)
                places, contents, held = [], [], 0
            places.append(i)
            contents.append(content)
            held += len(content)
            del content
            if held >= STREAM_CHUNK:
                yield _with_content(batch.take(pa.array(places)), contents)
                places, contents, held = [], [], 0
        if contents:
            yield _with_content(batch.take(pa.array(places)), contents)


def _contents(listed: DataFrame, *keep: str) -> DataFrame:
    """path, the columns ``keep`` of a listing (path, size_bytes, ...), and the bytes of its files.

    Only what names the files moves to the tasks that read them. Spark takes these rows for as small as
    the listing: where they meet a table, say which side is broadcast.
    """
    spark = listed.sparkSession
    total = listed.agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes")).first()
    wanted = max(-(-total["files"] // READ_FILES), -(-(total["bytes"] or 0) // READ_BYTES))
    tasks = max(spark.sparkContext.defaultParallelism, min(wanted, MOST_TASKS))
    rows = listed.select("path", *keep)
    shape = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())])
    return rows.repartition(tasks, "path").mapInArrow(_read_bytes, shape)


def read_every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Contents of files, one at a time; one that cannot be read is an error."""
    for batch in batches:
        for path in batch["path"]:
            system, inside, _ = place(path)
            with system.open_input_stream(inside) as stream:
                yield pd.DataFrame({"path": [path], "content": [stream.read()]})


def read_files(
    spark: SparkSession,
    root: str | list[str],
    up_to_bytes: int | None = None,
    listed: DataFrame | None = None,
) -> DataFrame:
    """All files below ``root`` (or the listed ones) with their bytes in ``content``; files that
    cannot be read are left out.

    With ``up_to_bytes`` larger files are left out and their bytes never loaded. Tasks read what
    the listing names, so the driver holds no list of files, as Spark's own file index would there.
    """
    listed = listing(spark, root) if listed is None else listed
    fits = F.col("size_bytes").isNotNull()
    if up_to_bytes is not None:
        fits = fits & (F.col("size_bytes") <= up_to_bytes)
    contents = _contents(listed.where(fits))
    return described(
        contents.withColumn("size_bytes", F.octet_length("content").cast("long"))
    )


def choose_files(
    files: DataFrame, extensions: Iterable[str] = EXTENSIONS, max_files: int | None = None
) -> DataFrame:
    """Files with a wanted extension; with a limit, the first ones in path order.

    Apply a limit to a listing, not to rows that carry contents.
    """
    wanted = files.where(is_allowed_extension(F.col("ext"), list(extensions)))
    return wanted if max_files is None else wanted.orderBy("path_abs").limit(max_files)


def relative_path(path: Column, root: str | None) -> Column:
    if not root:
        return F.lit(None).cast("string")
    base = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(base)), F.substring(path, len(base) + 1, 1 << 30))


def with_fingerprint(files: DataFrame) -> DataFrame:
    """Adds the SHA-256 of the bytes and the type; drops the bytes."""
    text = drop_bad_utf8(F.col("content"))
    return files.withColumns(
        {
            "sha256": F.sha2(F.col("content"), 256),
            "detected_type": detected_type(F.col("filename"), text),
        }
    ).drop("content")


def _stream_file(path: str) -> tuple[str | None, str]:
    """SHA-256 of a file read chunk by chunk (null: unreadable), and which of the markers that
    type detection looks for it holds. No more than a chunk is kept."""
    system, inside, _ = place(path)
    digest, found, tail = hashlib.sha256(), set(), b""
    markers = {m.lower().encode(): m for m in (MWTAB_MARKER, HTML_MARKER)}
    keep = max(map(len, markers)) - 1
    try:
        with system.open_input_stream(inside) as stream:
            while chunk := stream.read(STREAM_CHUNK):
                digest.update(chunk)
                low = (tail + chunk).lower()
                found |= {name for marker, name in markers.items() if marker in low}
                tail = low[-keep:]
    except OSError:
        return None, ""
    return digest.hexdigest(), "\n".join(sorted(found))


def fingerprint_large(listed: DataFrame) -> DataFrame:
    """As ``with_fingerprint`` for a listing of files that do not fit into one row.

    Every file is streamed by one task, and a task takes one file at a time from its own; a file
    that cannot be read has no row.
    """

    def hash_files(batches):
        for batch in batches:
            found = [_stream_file(path) for path in batch["path_abs"]]
            yield batch.assign(sha256=[f[0] for f in found], head=[f[1] for f in found])

    rows = listed.select("path_abs", "filename", "ext", "size_bytes")
    schema = "path_abs string, filename string, ext string, size_bytes long, sha256 string, head string"
    # as many tasks as files, so that two of the largest do not wait for each other
    tasks = max(1, min(listed.count(), 10_000))
    hashed = rows.repartition(tasks, "path_abs").mapInPandas(hash_files, schema)
    kind = detected_type(F.col("filename"), F.col("head"))
    return hashed.where("sha256 IS NOT NULL").withColumn("detected_type", kind).drop("head")


def registry_rows(
    files: DataFrame, import_id: str, root: str | None = None, created_at=None
) -> DataFrame:
    """Registry candidates of fingerprinted files, not yet compared with what is stored.

    They have all columns of ``schemas.FILES``. Without ``created_at`` it is the time of the query.
    """
    when = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    none = F.lit(None).cast("string")
    return files.select(
        row_id(F.col("sha256"), F.col("size_bytes"), F.col("path_abs")).alias("file_id"),
        F.lit(import_id).alias("import_id"),
        relative_path(F.col("path_abs"), root).alias("path_rel"),
        "path_abs",
        "filename",
        "ext",
        "size_bytes",
        "sha256",
        "detected_type",
        *[none.alias(c) for c in ("device", "exposure", "sample_type", "platform")],
        F.lit("pending").alias("parse_status"),
        none.alias("parse_error"),
        F.lit(None).cast("timestamp").alias("parsed_at"),
        when.alias("created_at"),
    )


def read_texts(
    spark: SparkSession,
    root: str | None = None,
    up_to_bytes: int | None = None,
    *,
    listed: DataFrame | None = None,
) -> DataFrame:
    """(file_id = path, content) for parsing, one row per file, without a byte-order mark.

    With ``up_to_bytes`` larger files are left out, for ``read_lines``, and their bytes never loaded.
    ``listed`` (file_id, path, size_bytes, ...) names the files in the place of ``root``; all its columns
    but the size are kept.
    """
    if listed is None:
        files = read_files(spark, root, up_to_bytes).withColumnRenamed("path_abs", "file_id")
        names = ["file_id"]
    else:
        if up_to_bytes is not None:
            listed = listed.where(F.col("size_bytes") <= up_to_bytes)
        names = [c for c in listed.columns if c != "size_bytes"]
        files = _contents(listed, *[c for c in names if c != "path"])
    text = without_mark(drop_bad_utf8(F.col("content")))
    return files.select(*names, text.alias("content"))


def _lines_of(stream, start: int, stop: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Offsets and bytes of the lines that begin in a range of a file.

    A line that begins before the range is another range's, and the last one is read to its end.
    """
    at, begun = start, False
    if start:
        stream.seek(start - 1)
        before, first = stream.read(1), stream.read(1)
        if before == b"\r" and first == b"\n":
            at += 1  # the second half of a line end
        begun = before not in (b"\r", b"\n")
    stream.seek(at)
    held = b""
    while at < stop:
        chunk = stream.read(STREAM_CHUNK)
        lines = (held + chunk).splitlines(keepends=True)  # bytes: at line feed and carriage return only
        # the last line may go on in the next chunk
        held = lines.pop() if len(chunk) == STREAM_CHUNK and lines else b""
        offsets = []
        for line in lines:
            offsets.append(at)
            at += len(line)
        inside = bisect_left(offsets, stop)
        skipped = int(begun and bool(lines))
        begun = begun and not lines
        kept = [line.rstrip(b"\r\n") for line in lines[skipped:inside]]
        if kept:
            yield offsets[skipped:inside], kept
        if len(chunk) < STREAM_CHUNK:
            return


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            system, inside, _ = place(path)
            try:
                stream = system.open_input_file(inside)
            except OSError:
                continue
            with stream:
                for offsets, lines in _lines_of(stream, start, stop):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(lines), pa.string()),
                            pa.array(offsets, pa.int64()),
                            pa.array(lines, pa.binary()),
                        ],
                        names=["path", "offset", "line"],
                    )


def read_lines(
    spark: SparkSession,
    root: str | list[str] | None = None,
    over_bytes: int | None = None,
    *,
    listed: DataFrame | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """(file_id, no, text) of every line, for files too large for one row, hidden ones included.

    Files below ``root``, or ``listed`` (path, size_bytes), are cut into byte ranges, which tasks read
    on their own. ``no`` is the offset of the line in its file: it orders the lines, and is the same
    however the files are cut. With ``over_bytes`` only larger files are read.
    """
    found = listing(spark, root) if listed is None else listed
    found = found.where(F.col("size_bytes") > (over_bytes or 0))
    starts = F.sequence(F.lit(0).cast("long"), F.col("size_bytes") - 1, F.lit(range_bytes).cast("long"))
    ranges = found.select("path", "size_bytes", F.explode(starts).alias("start")).select(
        "path", "start", F.least(F.col("start") + range_bytes, "size_bytes").alias("stop")
    )
    total = found.agg(F.sum(F.ceil(F.col("size_bytes") / range_bytes))).first()[0] or 1
    tasks = int(min(total, MOST_TASKS))
    read = ranges.repartition(tasks, "path", "start").mapInArrow(
        _read_ranges, "path string, offset long, line binary"
    )
    return read.select(
        F.col("path").alias("file_id"),
        F.struct(F.col("offset"), F.lit(0).cast("long").alias("at")).alias("no"),
        without_mark(drop_bad_utf8(F.col("line"))).alias("text"),
    )


def types_of_lines(lines: DataFrame) -> DataFrame:
    """(file_id, detected_type, layout) from all lines of each file."""
    low = F.lower("text")
    marks = [
        F.max(F.contains(low, F.lit(marker.lower()))).alias(f"m{i}")
        for i, marker in enumerate((MWTAB_MARKER, HTML_MARKER))
    ]
    content = F.concat_ws(
        " ", F.when(F.col("m0"), F.lit(MWTAB_MARKER)), F.when(F.col("m1"), F.lit(HTML_MARKER))
    )
    found = lines.groupBy("file_id").agg(*marks, layout_of_lines(F.col("no"), F.col("text")).alias("layout"))
    kind = detected_type(filename_of(F.col("file_id")), content)
    return found.select("file_id", kind.alias("detected_type"), "layout")


def line_weights(spark: SparkSession, root: str) -> DataFrame:
    """(file_id, n) estimated from file sizes: finds the large files without reading them."""
    listed = list_files(spark, root).where("size_bytes IS NOT NULL")
    return listed.select(F.col("path_abs").alias("file_id"), (F.col("size_bytes") / 64).alias("n"))
