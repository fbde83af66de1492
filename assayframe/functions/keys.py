"""Stable natural keys for samples and features, and normalised names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions.text import collapse_spaces, strip

# The formats below must stay as they are, since stored keys use them.
UNKNOWN_ID = "UNKNOWN"
METABOLITE_TAG = "met"
NMR_BIN_TAG = "nmrbin"
NMR_SAMPLE_TAG = "s"
LONG_NAME = 100  # longer normalised names are replaced by a hash
LONG_NAME_HASH = 16
NMR_HASH = 12
SAMPLE_LABEL_UNSAFE = "[^A-Za-z0-9._-]"
FEATURE_NAME_UNSAFE = "[^a-z0-9._\\-,()` ]"


def known_or_unknown(identifier: Column) -> Column:
    return F.coalesce(F.nullif(identifier, F.lit("")), F.lit(UNKNOWN_ID))


def _single_underscores(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "_+", "_"), F.lit("_"))


def normalize_sample_label(label: Column) -> Column:
    return _single_underscores(F.regexp_replace(strip(label), SAMPLE_LABEL_UNSAFE, "_"))


def normalize_feature_name(name: Column) -> Column:
    return F.lower(collapse_spaces(strip(name)))


def sample_uid(study_id: Column, label: Column) -> Column:
    return F.concat(study_id, F.lit(":"), label)


def feature_uid(analysis_id: Column, name: Column) -> Column:
    return F.concat(analysis_id, F.lit(f":{METABOLITE_TAG}:"), normalize_feature_name(name))


def ms_feature_uid(analysis_id: Column, name: Column, refmet: Column) -> Column:
    normal = normalize_feature_name(name)
    hashed = F.substring(
        F.md5(F.concat(name, F.lit("|"), F.coalesce(refmet, F.lit("")))), 1, LONG_NAME_HASH
    )
    safe = _single_underscores(F.regexp_replace(normal, FEATURE_NAME_UNSAFE, "_"))
    tail = F.when(F.length(normal) > LONG_NAME, hashed).otherwise(safe)
    return F.concat(analysis_id, F.lit(f":{METABOLITE_TAG}:"), tail)


def nmr_sample_uid(study_id: Column, analysis_id: Column, label: Column) -> Column:
    tail = F.substring(F.sha1(label), 1, NMR_HASH)
    return F.concat(study_id, F.lit(":"), analysis_id, F.lit(f":{NMR_SAMPLE_TAG}:"), tail)


def nmr_feature_uid(analysis_id: Column, bin_range: Column) -> Column:
    tail = F.substring(F.sha1(bin_range), 1, NMR_HASH)
    return F.concat(analysis_id, F.lit(f":{NMR_BIN_TAG}:"), tail)


def row_id(*parts: Column) -> Column:
    """Deterministic surrogate id of a natural key (re-runs and retries give the same id)."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])), 256)
