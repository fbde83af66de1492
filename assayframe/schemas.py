"""Table schemas and status domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, H, D, TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.ShortType(),
    T.DoubleType(),
    T.TimestampType(),
)


def _table(required: dict, optional: dict) -> T.StructType:
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in optional.items()])


def conform(df: DataFrame, shape: T.StructType, *more: Column) -> DataFrame:
    """The columns of a table in its types and order; those that ``df`` lacks are null."""
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape
    ]
    return df.select(*columns, *more)


IMPORTS = _table(
    {"import_id": S, "created_at": TS, "status": S}, {"root_path": S, "notes": S}
)
FILES = _table(
    {
        "file_id": S,
        "import_id": S,
        "path_abs": S,
        "filename": S,
        "ext": S,
        "size_bytes": L,
        "sha256": S,
        "detected_type": S,
        "parse_status": S,
        "created_at": TS,
    },
    {
        "path_rel": S,
        "device": S,
        "exposure": S,
        "sample_type": S,
        "platform": S,
        "parse_error": S,
        "parsed_at": TS,
    },
)
STUDIES = _table({"study_pk": S, "study_id": S}, {"created_at": TS})
ANALYSES = _table(
    {"analysis_pk": S, "study_pk": S, "analysis_id": S},
    {"file_id": S, "device": S, "created_at": TS},
)
SAMPLES = _table(
    {"sample_uid": S, "study_pk": S, "sample_label": S},
    {"factors_raw": S, "exposure": S, "sample_matrix": S, "created_at": TS},
)
SAMPLE_FACTORS = _table(
    {"sample_uid": S, "factor_key": S, "factor_value": S}, {"created_at": TS}
)
FEATURES = _table(
    {"feature_uid": S, "feature_type": S},
    {"name_raw": S, "refmet_name": S, "analysis_id": S, "created_at": TS},
)
MEASUREMENTS = _table(
    {"sample_uid": S, "feature_uid": S},
    {
        "value": D,
        "unit": S,
        "file_id": S,
        "col_index": I,
        "replicate_ix": H,
        "created_at": TS,
    },
)

SHAPES = {
    "imports": IMPORTS,
    "files": FILES,
    "studies": STUDIES,
    "analyses": ANALYSES,
    "samples": SAMPLES,
    "sample_factors": SAMPLE_FACTORS,
    "features": FEATURES,
    "measurements": MEASUREMENTS,
}

# The export row, in order. col_index and replicate_ix are doubles and
# created_at is text there.
EXPORT_COLUMNS = (
    "file_id",
    "path_rel",
    "detected_type",
    "device",
    "exposure",
    "sample_type",
    "platform",
    "sample_uid",
    "sample_label",
    "feature_uid",
    "feature_type",
    "feature_name",
    "refmet_name",
    "value",
    "unit",
    "col_index",
    "replicate_ix",
    "study_id",
    "analysis_id",
    "created_at",
)

# Status domains.
IMPORT_STATUSES = ("running", "success", "failed")
PARSE_STATUSES = ("pending", "success", "failed", "skipped")
FEATURE_METABOLITE = "metabolite"
FEATURE_NMR_BIN = "nmr_bin"
