"""File name parts, allowed extensions and type detection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions.rules import first_class
from assayframe.functions.text import first_lines

# --- Fixed values: extensions and markers. ---

EXTENSIONS = (".txt", ".htm", ".html", ".csv", ".tsv", ".xlsx", ".xlsm", ".zip", ".pdf")
MWTAB_MARKER = "#METABOLOMICS WORKBENCH"
HTML_MARKER = "metabolite_name"
RESULTS_MARKER = "_res.txt"
BINNED_MARKER = "normalized binned data"

# --- end of fixed values ---


def filename_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension_of(filename: Column) -> Column:
    """Lower-case suffix with its dot; '' without one. A leading dot starts no suffix."""
    return F.lower(F.regexp_extract(filename, r"[^.].*?(\.[^.]+)$", 1))


def normalize_extensions(extensions: Iterable[str]) -> list[str]:
    return sorted({(e if e.startswith(".") else "." + e).lower() for e in extensions})


def is_allowed_extension(extension: Column, extensions: Iterable[str] = EXTENSIONS) -> Column:
    return F.lower(extension).isin(*normalize_extensions(extensions))


def has_mwtab_marker(content: Column, max_lines: int | None = None) -> Column:
    """Marker in one of the lines, or of the first ``max_lines``. Unreadable (NULL) content
    counts as no."""
    head = F.upper(first_lines(content, max_lines) if max_lines else content)
    return F.coalesce(F.contains(head, F.lit(MWTAB_MARKER)), F.lit(False))


def detected_type(
    filename: Column,
    content: Column,
    max_lines: int | None = None,
    max_chars: int | None = None,
) -> Column:
    """Type by name and whole text. A caller may have only the first lines (plain text) or
    characters (HTML) looked at."""
    name = F.lower(filename)
    ext = extension_of(filename)
    html_head = F.lower(F.substring(content, 1, max_chars) if max_chars else content)
    known = first_class(
        [
            ("results_txt", F.contains(name, F.lit(RESULTS_MARKER))),
            (
                "nmr_binned_xlsx",
                ext.isin(".xlsx", ".xlsm") & F.contains(name, F.lit(BINNED_MARKER)),
            ),
            ("mwtab", (ext == ".txt") & has_mwtab_marker(content, max_lines)),
            (
                "metabo_table_html",
                ext.isin(".htm", ".html") & F.contains(html_head, F.lit(HTML_MARKER)),
            ),
        ]
    )
    return F.coalesce(known, F.lit("unknown"))
