"""File tags from path, name and type: word-boundary rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions.rules import all_classes, first_class, matches_any

# --- Fixed values: rule vocabularies. Order matters in every list. ---

NMR_TYPES = ("nmr_binned_xlsx", "nmr_binned_xlsm", "mwtab_nmr_binned")
MS_TYPES = ("mwtab", "mwtab_ms", "metabo_table_html")

GC_PATHS = (
    r"\bGC[-_\s]?MS\b",
    r"\bGCMS\b",
    r"\bGC[-_]TOF\b",
    r"\b_GC_",
    r"\bGC[-_\s]?EI\b",
    r"/GC/",
)
NMR_PATHS = (r"\bNMR\b", r"\b1H[-_]?NMR\b", r"\b13C[-_]?NMR\b", r"/NMR/")
LC_PATHS = (r"\bLC[-_\s]?MS\b", r"\bLCMS\b", r"\bHPLC\b", r"\bUPLC\b", r"\bUHPLC\b")

SAMPLE_TYPES = (
    ("Serum", (r"\bserum\b", r"\bplasma\b", r"\bblood\b")),
    ("Urine", (r"\burine\b", r"\burinary\b")),
    ("Feces", (r"\bfeces\b", r"\bfaeces\b", r"\bstool\b", r"\bfecal\b", r"\bfaecal\b")),
    ("CSF", (r"\bcsf\b", r"\bcerebrospinal\b")),
)

OB_WORDS = (
    r"\bOB\b",
    r"\bobese\b",
    r"\bobesity\b",
    r"\boverweight\b",
    r"\bcase\b",
    r"\bhigh[-_\s]?BMI\b",
    r"\bBMI[-_]?[>3]\d",
)
CON_WORDS = (
    r"\bCON\b",
    r"\bcontrol\b",
    r"\blean\b",
    r"\bnormal\b",
    r"\bhealthy\b",
    r"\breference\b",
    r"\blow[-_\s]?BMI\b",
)

PLATFORMS = (
    (r"\bESI[-_\s]?pos(?:itive)?\b", "ESI_pos"),
    (r"\bESI[-_\s]?neg(?:ative)?\b", "ESI_neg"),
    (r"\bpositive[-_\s]?mode\b", "ESI_pos"),
    (r"\bnegative[-_\s]?mode\b", "ESI_neg"),
    (r"\b\+ESI\b", "ESI_pos"),
    (r"\b-ESI\b", "ESI_neg"),
    (r"\bAPCI[-_\s]?pos\b", "APCI_pos"),
    (r"\bAPCI[-_\s]?neg\b", "APCI_neg"),
    (r"\bHILIC\b", "HILIC"),
    (r"\bRP\b", "RP"),
    (r"\bC18\b", "C18"),
    (r"\bC8\b", "C8"),
    (r"\bQQQ\b", "QQQ"),
    (r"\btriple[-_\s]?quad\b", "QQQ"),
    (r"\bQTOF\b", "QTOF"),
    (r"\bQ[-_]?TOF\b", "QTOF"),
    (r"\bOrbitrap\b", "Orbitrap"),
    (r"\bTripleTOF\b", "TripleTOF"),
    (r"\bTOF\b", "TOF"),
    (r"\bUPLC\b", "UPLC"),
    (r"\bUHPLC\b", "UHPLC"),
    (r"\bHPLC\b", "HPLC"),
)
MAX_PLATFORMS = 3

EXPOSURE_CONFLICT = "Conflicting exposure patterns in path: found both OB and CON indicators"

# --- end of fixed values ---


def path_text(path_rel: Column, filename: Column) -> Column:
    blank = F.lit("")
    return F.lower(F.concat_ws(" ", F.coalesce(path_rel, blank), F.coalesce(filename, blank)))


def device_tag(text: Column, detected_type: Column) -> Column:
    gc = matches_any(text, GC_PATHS)
    kind = F.coalesce(detected_type, F.lit(""))
    return first_class(
        [
            ("NMR", kind.isin(*NMR_TYPES)),
            ("GCMS", kind.isin(*MS_TYPES) & gc),
            ("LCMS", kind.isin(*MS_TYPES)),
            ("NMR", matches_any(text, NMR_PATHS)),
            ("GCMS", gc),
            ("LCMS", matches_any(text, LC_PATHS)),
        ]
    )


def sample_type_tag(text: Column) -> Column:
    return first_class([(label, matches_any(text, words)) for label, words in SAMPLE_TYPES])


def exposure_signs(text: Column) -> tuple[Column, Column]:
    """(case words present, control words present)"""
    return matches_any(text, OB_WORDS), matches_any(text, CON_WORDS)


def exposure_tag(text: Column) -> Column:
    ob, con = exposure_signs(text)
    return first_class([("OB", ob & ~con), ("CON", con & ~ob)])


def exposure_warning(text: Column) -> Column:
    ob, con = exposure_signs(text)
    return F.when(ob & con, F.lit(EXPOSURE_CONFLICT))


def platform_tag(text: Column) -> Column:
    found = all_classes([(name, matches_any(text, [rule])) for rule, name in PLATFORMS])
    return F.nullif(F.array_join(F.slice(found, 1, MAX_PLATFORMS), "_"), F.lit(""))


def all_tags(path_rel: Column, filename: Column, detected_type: Column) -> Column:
    """struct<device, sample_type, exposure, platform, warnings> of one file."""
    text = path_text(path_rel, filename)
    return F.struct(
        device_tag(text, detected_type).alias("device"),
        sample_type_tag(text).alias("sample_type"),
        exposure_tag(text).alias("exposure"),
        platform_tag(text).alias("platform"),
        F.array_compact(F.array(exposure_warning(text))).alias("warnings"),
    )
