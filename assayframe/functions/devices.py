"""Device and category classifiers used by derivation: substring and regex vocabularies.

These differ on purpose from the word-boundary rules in ``tags``: factor values
are matched by substring, file content by its own device patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions.rules import contains_any, first_class, matches_any

# --- Fixed values: rule vocabularies. Order matters in every list. ---

GCMS_PATTERNS = (
    r"\bGC[-_\s]?MS\b",
    r"\bGCMS\b",
    r"\bgas\s+chromatograph",
    r"\bGC\s+mass\s+spectrom",
)
LCMS_PATTERNS = (
    r"\bLC[-_\s]?MS\b",
    r"\bLCMS\b",
    r"\bliquid\s+chromatograph",
    r"\bHPLC[-_\s]?MS\b",
    r"\bUHPLC\b",
    r"\bUPLC\b",
)
NMR_PATTERNS = (
    r"\bNMR\b",
    r"\bnuclear\s+magnetic\s+resonance\b",
    r"\b1H[-_\s]?NMR\b",
    r"\b13C[-_\s]?NMR\b",
)
CONTENT_TYPES = ("mwtab", "mwtab_ms", "text/plain")

EXPOSURE_KEYS = (
    "group",
    "cohort",
    "exposure",
    "casecontrol",
    "case_control",
    "obesity",
    "status",
    "condition",
    "treatment",
    "phenotype",
    "constitution",
    "bmi",
    "category",
    "class",
    "diagnosis",
)
OB_VALUES = ("ob", "obese", "obesity", "case", "overweight", "bmi>")
CON_VALUES = ("con", "control", "lean", "normal", "healthy", "reference")
EXCLUDED_VALUES = (
    "exercise",
    "acute",
    "pool",
    "pooled",
    "qc",
    "blank",
    "standard",
    "baseline",
    "treatment",
    "intervention",
)
EXCLUSION_OVERRIDES = ("obese", "obesity", "lean")
STUDY_NAMES = ("obesity and hdl function",)
EXACT_SCORE = 10
PARTIAL_SCORE = 5

MATRIX_KEYS = (
    "matrix",
    "sample_type",
    "sampletype",
    "biofluid",
    "specimen",
    "biospecimen",
    "sample",
    "tissue",
    "material",
    "samplesource",
    "sample_source",
    "source",
    "bodyfluid",
    "body_fluid",
)
MATRIX_VALUES = (
    ("Serum", ("serum", "blood serum", "plasma", "blood")),
    ("Urine", ("urine", "urinary")),
    ("Feces", ("feces", "faeces", "stool", "fecal", "faecal")),
    ("CSF", ("csf", "cerebrospinal", "spinal fluid")),
    ("Tissue", ("tissue", "mammary", "liver", "muscle", "adipose")),
)

TEXT_NMR = (r"\bnmr\b", r"\bnuclear\s+magnetic")
TEXT_GCMS = (
    r"\bgc[-_\s]?ms\b",
    r"\bgcms\b",
    r"\bgas\s+chromatograph",
    r"\bgc[/]ms\b",
    r"\bgc\s+mass\s*spec",
    r"\bgc[-_\s]?tof",
)
TEXT_LCMS = (
    r"\blc[-_\s]?ms\b",
    r"\blcms\b",
    r"\bliquid\s+chromatograph",
    r"\bhplc",
    r"\buhplc\b",
    r"\buplc\b",
    r"\blc[/]ms",
    r"\blc[-_\s]?tof",
)
TEXT_OB = ("ob", "obese", "obesity", "case", "overweight")
TEXT_CON = ("con", "control", "lean", "normal", "healthy")
TEXT_MATRIX = (
    ("Serum", ("serum", "plasma", "blood")),
    ("Urine", ("urine", "urinary")),
    ("Feces", ("feces", "faeces", "stool", "fecal")),
    ("CSF", ("csf", "cerebrospinal")),
    ("Tissue", ("tissue", "mammary", "liver", "muscle", "adipose")),
)

# --- end of fixed values ---


def device_from_content(content: Column, max_chars: int | None = None) -> Column:
    """Device named in a file's text, or in its first ``max_chars`` characters."""
    head = F.lower(F.substring(content, 1, max_chars) if max_chars else content)
    return first_class(
        [
            ("NMR", matches_any(head, NMR_PATTERNS)),
            ("GCMS", matches_any(head, GCMS_PATTERNS)),
            ("LCMS", matches_any(head, LCMS_PATTERNS)),
            ("MS", F.contains(head, F.lit("ms_metabolite_data"))),
        ]
    )


def device_of_file(
    path_abs: Column,
    filename: Column,
    detected_type: Column,
    content: Column,
    max_chars: int | None = None,
) -> Column:
    """Type, then path, then content, then path again. NULL content means unreadable."""
    kind = F.lower(F.coalesce(detected_type, F.lit("")))
    path = F.lower(
        F.concat_ws(" ", F.coalesce(path_abs, F.lit("")), F.coalesce(filename, F.lit("")))
    )
    by_name = F.when(
        F.contains(kind, F.lit("nmr")) | matches_any(path, NMR_PATTERNS), F.lit("NMR")
    )
    by_content = F.when(detected_type.isin(*CONTENT_TYPES), device_from_content(content, max_chars))
    by_path = first_class(
        [
            ("GCMS", matches_any(path, GCMS_PATTERNS)),
            ("LCMS", matches_any(path, LCMS_PATTERNS)),
            ("MS", contains_any(kind, ["ms", "metabolite"])),
        ]
    )
    return F.coalesce(by_name, by_content, by_path)


def plain_factor(key: Column, value: Column) -> Column:
    """Factor as the scores below read it: key without separators, value in lower case."""
    return F.struct(F.translate(key, "_- ", "").alias("key"), F.lower(value).alias("value"))


def _word_score(value: Column, words: tuple[str, ...]) -> Column:
    """Score of the first word contained in the value: 10 when it is the whole value.

    A word that contains an earlier one can never be first, so it never scores as exact.
    """
    first = [w for i, w in enumerate(words) if not any(e in w for e in words[:i])]
    return (
        F.when(value.isin(*first), F.lit(EXACT_SCORE))
        .when(contains_any(value, words), F.lit(PARTIAL_SCORE))
        .otherwise(F.lit(0))
    )


def exposure_scores(factor: Column) -> tuple[Column, Column]:
    """(case score, control score) of one plain factor."""
    value = factor["value"]
    counts = (
        contains_any(factor["key"], EXPOSURE_KEYS)
        & ~value.isin(*STUDY_NAMES)
        & (~contains_any(value, EXCLUDED_VALUES) | contains_any(value, EXCLUSION_OVERRIDES))
    )
    none = F.lit(0)
    return (
        F.when(counts, _word_score(value, OB_VALUES)).otherwise(none),
        F.when(counts, _word_score(value, CON_VALUES)).otherwise(none),
    )


def exposure_of_scores(ob: Column, con: Column) -> Column:
    """The higher score wins, a tie (also 0:0) gives NULL."""
    return first_class([("OB", ob > con), ("CON", con > ob)])


def exposure_conflict(ob: Column, con: Column) -> Column:
    return (ob > 0) & (con > 0)


# A set of matrix classes travels as a bit mask: a fixed-width value that the
# hash aggregate can merge in place with bit_or.


def _mask(text: Column, prefix: str = "") -> Column:
    mask = F.lit(0)
    for bit, (_, words) in enumerate(MATRIX_VALUES):
        hit = contains_any(text, [prefix + w for w in words])
        mask = mask.bitwiseOR(F.when(hit, F.lit(1 << bit)).otherwise(F.lit(0)))
    return mask


def matrix_mask(factor: Column) -> Column:
    """Bits of the matrix classes that one plain factor names."""
    relevant = contains_any(factor["key"], MATRIX_KEYS)
    return F.when(relevant, _mask(factor["value"])).otherwise(F.lit(0))


def matrix_mask_of_path(path: Column) -> Column:
    """Bits of the matrix classes that start a path segment."""
    return _mask(F.lower(path), "/")


def matrix_of_mask(mask: Column) -> Column:
    """The class, when exactly one bit is set."""
    return first_class(
        [(label, mask == (1 << bit)) for bit, (label, _) in enumerate(MATRIX_VALUES)]
    )


def matrix_conflict(mask: Column) -> Column:
    return F.bit_count(mask) > 1


def device_of_text(text: Column) -> Column:
    low = F.lower(text)
    return first_class(
        [
            ("NMR", matches_any(low, TEXT_NMR)),
            ("GCMS", matches_any(low, TEXT_GCMS)),
            ("LCMS", matches_any(low, TEXT_LCMS)),
            ("MS", contains_any(low, ["ms", "mass spec"])),
        ]
    )


def exposure_of_text(text: Column) -> Column:
    low = F.lower(text)
    return first_class([("OB", contains_any(low, TEXT_OB)), ("CON", contains_any(low, TEXT_CON))])


def matrix_of_text(text: Column) -> Column:
    low = F.lower(text)
    return first_class([(label, contains_any(low, words)) for label, words in TEXT_MATRIX])
