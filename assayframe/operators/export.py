"""Long export: the star of six tables, its filters, order, preview and count.

Every dimension is unique on its join key. The joins carry no hints: Catalyst
broadcasts a dimension when its size allows and sorts and merges otherwise, and
adaptive execution splits hot partitions of the measurement side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.schemas import EXPORT_COLUMNS

ORDER = ("file_id", "col_index", "feature_uid")


def _spread_null(key: Column, by: Iterable[str]) -> Column:
    """A join key whose NULLs do not meet in one partition: a hash of the columns ``by`` spreads them.

    Many measurements have no file. They match nothing, so they may carry any key that
    no file has. (No id starts with a NUL character.)
    """
    return F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*by).cast("string")))


# What each dimension needs to be joined.
NEEDS = {
    "files": (),
    "samples": (),
    "features": (),
    "studies": ("samples",),
    "analyses": ("features", "samples", "studies"),
}


def star(
    measurements: DataFrame,
    files: DataFrame,
    samples: DataFrame,
    features: DataFrame,
    studies: DataFrame,
    analyses: DataFrame,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """The left-joined star; columns keep their table's prefix (m_, f_, s_, ft_, st_, a_).

    The dimension with the widest rows, files, comes last, so that the shuffles to the others do not
    carry its paths.

    ``only`` names the dimensions that are used: as they are unique on their keys, the
    left joins with the others change nothing. (Catalyst cannot know that.)
    """
    wanted = set(NEEDS if only is None else only)
    wanted |= {needed for name in wanted for needed in NEEDS[name]}

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select([F.col(c).alias(f"{prefix}_{c}") for c in df.columns])

    c = F.col
    # by columns that are there anyway: a key that was joined need not travel on
    spread_by = ["s_sample_uid" if "samples" in wanted else "m_sample_uid"]
    spread_by += ["ft_feature_uid" if "features" in wanted else "m_feature_uid", "m_value"]
    file_key = _spread_null(c("m_file_id"), spread_by)
    same_analysis = c("ft_analysis_id") == c("a_analysis_id")
    joins = [
        ("samples", samples, "s", c("m_sample_uid") == c("s_sample_uid")),
        ("features", features, "ft", c("m_feature_uid") == c("ft_feature_uid")),
        ("studies", studies, "st", c("s_study_pk") == c("st_study_pk")),
        ("analyses", analyses, "a", same_analysis & (c("a_study_pk") == c("st_study_pk"))),
        ("files", files, "f", file_key == c("f_file_id")),
    ]
    out = prefixed(measurements, "m")
    for name, dim, prefix, on in joins:
        if name in wanted:
            out = out.join(prefixed(dim, prefix), on, "left")
    return out


def filtered(
    star_df: DataFrame,
    *,
    file_id: str | None = None,
    import_id: str | None = None,
    feature_type: str | None = None,
    study_id: str | None = None,
) -> DataFrame:
    """AND of the given filters. Each turns its left join into an inner join."""
    wanted = {
        "f_file_id": file_id,
        "f_import_id": import_id,
        "ft_feature_type": feature_type,
        "st_study_id": study_id,
    }
    for column, value in wanted.items():
        if value:
            star_df = star_df.where(F.col(column) == F.lit(value))
    return star_df


def timestamp_text(ts: Column) -> Column:
    """'2024-01-31 12:00:00[.ffffff]+00:00' (session time zone UTC)."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    part = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(part == ".000000", "").otherwise(part), F.lit("+00:00"))


# Where the columns of an export row come from.
SOURCES = {
    "file_id": "f_file_id",
    "path_rel": "f_path_rel",
    "detected_type": "f_detected_type",
    "device": "f_device",
    "exposure": "f_exposure",
    "sample_type": "f_sample_type",
    "platform": "f_platform",
    "sample_uid": "s_sample_uid",
    "sample_label": "s_sample_label",
    "feature_uid": "ft_feature_uid",
    "feature_type": "ft_feature_type",
    "feature_name": "ft_name_raw",
    "refmet_name": "ft_refmet_name",
    "value": "m_value",
    "unit": "m_unit",
    "col_index": "m_col_index",
    "replicate_ix": "m_replicate_ix",
    "study_id": "st_study_id",
    "analysis_id": "a_analysis_id",
    "created_at": "m_created_at",
}
DIMENSIONS = {"f": "files", "s": "samples", "ft": "features", "st": "studies", "a": "analyses"}


def export_columns(star_df: DataFrame, columns: Iterable[str] = EXPORT_COLUMNS) -> DataFrame:
    """Columns of the export row (all 20 when not told)."""
    shaped = {
        "col_index": lambda x: x.cast("double"),
        "replicate_ix": lambda x: x.cast("double"),
        "created_at": timestamp_text,
    }
    return star_df.select(
        [shaped.get(c, lambda x: x)(F.col(SOURCES[c])).alias(c) for c in columns]
    )


def reduced(
    tables: dict[str, DataFrame],
    *,
    file_id: str | None = None,
    import_id: str | None = None,
    feature_type: str | None = None,
    study_id: str | None = None,
) -> DataFrame:
    """The measurements that the filters leave, by semi-joins with the keys of filtered dimensions.

    All joins of the star then see these rows alone, and a dimension that only a filter asked for
    is not joined again. The key of a file is filtered in the scan, too.
    """
    rows = tables["measurements"]
    if file_id or import_id:
        files = tables["files"]
        if file_id:
            files = files.where(F.col("file_id") == file_id)
            rows = rows.where(F.col("file_id") == file_id)
        if import_id:
            files = files.where(F.col("import_id") == import_id)
        rows = rows.join(files.select("file_id"), "file_id", "left_semi")
    if feature_type:
        wanted = tables["features"].where(F.col("feature_type") == feature_type)
        rows = rows.join(wanted.select("feature_uid"), "feature_uid", "left_semi")
    if study_id:
        study = tables["studies"].where(F.col("study_id") == study_id).select("study_pk")
        samples = tables["samples"].join(study, "study_pk", "left_semi").select("sample_uid")
        rows = rows.join(samples, "sample_uid", "left_semi")
    return rows


def export_long(
    tables: dict[str, DataFrame], columns: Iterable[str] = EXPORT_COLUMNS, **filters: str | None
) -> DataFrame:
    """Filtered export rows, unordered. Dimensions that nothing asks for are not joined.

    Measurements are reduced by the filters before they meet the star.
    """
    columns = list(columns)
    prefixes = {SOURCES[c].split("_", 1)[0] for c in columns}
    only = {DIMENSIONS[p] for p in prefixes if p in DIMENSIONS}
    facts = {**tables, "measurements": reduced(tables, **filters)}
    return export_columns(star(**facts, only=only), columns)


def in_export_order(exported: DataFrame) -> DataFrame:
    return exported.orderBy(*[F.asc_nulls_last(c) for c in ORDER])


def preview(tables: dict[str, DataFrame], limit: int = 10, **filters: str | None) -> DataFrame:
    """First rows in export order; a top-n, not a full sort. Ties follow the sample.

    Only measurements that can be among them meet the star: see ``_first_measurements``.
    """
    facts = _first_measurements(reduced(tables, **filters), tables["files"], limit)
    rows = export_long({**tables, "measurements": facts})
    ties = [F.asc_nulls_last(c) for c in ("sample_uid", "value", "replicate_ix", "unit", "created_at")]
    return rows.orderBy(*[F.asc_nulls_last(c) for c in ORDER], *ties).limit(limit)


def _first_measurements(rows: DataFrame, files: DataFrame, limit: int) -> DataFrame:
    """The measurements whose file and column can be among the first ``limit`` rows of the export.

    They are counted by file and column, which combines before the shuffle; every group gives a row at
    least, so what comes behind the ``limit``-th group, ties with it included, is left out.
    """
    known = files.select(F.col("file_id").alias("_known")).distinct()
    groups = rows.select("file_id", "col_index").distinct()
    groups = groups.join(known, F.col("file_id") == F.col("_known"), "left")
    rank = F.struct(
        F.col("_known").isNull().alias("no_file"),
        F.coalesce("_known", F.lit("")).alias("file"),
        F.col("col_index").isNull().alias("no_column"),
        F.coalesce("col_index", F.lit(0)).alias("column"),
    )
    groups = groups.withColumn("_place", rank)
    last = groups.orderBy("_place").limit(limit).agg(F.max("_place").alias("_last"))
    kept = groups.join(F.broadcast(last), F.col("_place") <= F.col("_last")).select(
        F.col("file_id").alias("_file"), F.col("col_index").alias("_column")
    )
    same = F.col("file_id").eqNullSafe(F.col("_file")) & F.col("col_index").eqNullSafe(F.col("_column"))
    return rows.join(kept, same, "left_semi")


def export_count(tables: dict[str, DataFrame], **filters: str | None) -> DataFrame:
    """Number of rows an export would have.

    Dimensions are unique on their keys, so a left join without a filter changes no
    count: only filtered tables are joined, as semi-joins.
    """
    return reduced(tables, **filters).agg(F.count("*").alias("row_count"))


def long_view(tables: dict[str, DataFrame]) -> DataFrame:
    """The analysis view: 19 columns, with the sample's exposure and matrix."""
    source = {
        "measurement_id": "m_measurement_id",
        "sample_uid": "s_sample_uid",
        "sample_label": "s_sample_label",
        "exposure": "s_exposure",
        "sample_matrix": "s_sample_matrix",
        "file_id": "f_file_id",
        "device": "f_device",
        "detected_type": "f_detected_type",
        "filename": "f_filename",
        "feature_uid": "ft_feature_uid",
        "feature_type": "ft_feature_type",
        "feature": "ft_name_raw",
        "refmet_name": "ft_refmet_name",
        "value": "m_value",
        "unit": "m_unit",
        "col_index": "m_col_index",
        "replicate_ix": "m_replicate_ix",
        "study_id": "st_study_id",
        "analysis_id": "a_analysis_id",
    }
    return star(**tables).select([F.col(c).alias(name) for name, c in source.items()])


def register_long_view(tables: dict[str, DataFrame], name: str = "v_long_measurements") -> None:
    long_view(tables).createOrReplaceTempView(name)
