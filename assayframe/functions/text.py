"""Column functions over text: trimming, line splitting, numbers, factor strings.

Everything here is a Spark expression; nothing runs in Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space when text is trimmed.
# (F.trim alone removes the plain space only.)
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a regex class; (?U) makes \s cover the Unicode spaces.
WHITESPACE_RUN = "(?U)[\\s\\x1c-\\x1f]+"

# Cell texts that mean "no measurement" (compared in upper case).
MISSING_CELLS = ("", "NA", "N/A", "NULL", "-", ".")

# Decimal grammar: digits may be grouped by single underscores; infinity and NaN
# are spelled out. A plain cast to double would also take "1.0d" and "0x1p3".
_DIGITS = "[0-9](?:_?[0-9])*"
NUMBER = (
    f"^[+-]?(?:(?:{_DIGITS}\\.?(?:{_DIGITS})?|\\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    "|(?i:inf|infinity|nan))$"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once.

    An expression used inside a lambda is evaluated again for every element, and the
    optimizer may move a column's definition into a lambda that mentions the column. A
    value bound here stays a lambda variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a column that is computed once for each row, whatever uses it.

    A filter that mentions a column is pushed below the projection that makes it, and the column's
    expression is then evaluated for the filter and again for what is kept. An explode is a boundary.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.array(column)).alias(column)).select(*df.columns)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space, Unicode spaces included.

    Most texts begin and end with a printable ASCII character and are taken as they are: a trim by a
    set compares each end with every character of the set.
    """
    clean = F.ascii(text).between(33, 126) & F.substring(text, -1, 1).between("!", "~")
    return F.when(clean, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def is_blank(text: Column) -> Column:
    """Nothing but white space; looks no further than the first other character."""
    return F.ltrim(text, F.lit(WHITESPACE)) == ""


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, WHITESPACE_RUN, " ")


def unix_newlines(text: Column) -> Column:
    """\\r\\n and \\r become \\n (plain replaces: the text is copied only where it holds \\r)."""
    no_pairs = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(no_pairs, F.lit("\r"), F.lit("\n"))


def split_lines(text: Column) -> Column:
    return F.split(unix_newlines(text), "\n")


def first_lines(text: Column, n: int) -> Column:
    return F.substring_index(unix_newlines(text), "\n", n)


def drop_bad_utf8(raw: Column) -> Column:
    """Decode bytes as UTF-8, leaving out what cannot be decoded."""
    text = raw.cast("string")
    repaired = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def without_mark(text: Column) -> Column:
    """The text without a byte-order mark at its beginning."""
    return F.when(F.startswith(text, F.lit("\ufeff")), F.substring(text, 2, 1 << 30)).otherwise(text)


def is_missing_cell(text: Column) -> Column:
    return text.isNull() | F.upper(strip(text)).isin(*MISSING_CELLS)


def _bare_number(text: Column) -> Column:
    return F.translate(strip(text), ", ", "")


def parse_number(text: Column) -> Column:
    """Text to double; missing markers and unreadable text give NULL.

    Thousands commas and inner spaces are dropped first. A text that is already a
    number holds neither, so one grammar test covers both spellings. Most cells hold
    digits and a point only: for them the cast alone decides.
    """
    bare = _bare_number(text)
    value = F.translate(bare, "_", "").try_cast("double")
    # the grammar holds but the cast does not for a signed NaN only
    number = F.coalesce(value, F.lit(float("nan")))
    digits_only = F.translate(text, "0123456789.", "") == ""
    return F.when(digits_only, text.try_cast("double")).when(
        ~is_missing_cell(text) & bare.rlike(NUMBER), number
    )


def is_unreadable_number(text: Column) -> Column:
    """True where a cell is neither missing nor a number (worth a warning)."""
    return ~is_missing_cell(text) & ~_bare_number(text).rlike(NUMBER)


def after_first(text: Column, delimiter: str) -> Column:
    """The part behind the first delimiter (whole text when there is none)."""
    at = F.locate(delimiter, text)
    return F.when(at > 0, F.substring(text, at + len(delimiter), F.length(text))).otherwise(text)


def before_first(text: Column, delimiter: str) -> Column:
    return F.substring_index(text, delimiter, 1)


def _factor_pieces(raw: Column) -> Column:
    pieces = F.transform(F.split(raw, "\\|"), strip)
    empty = F.array().cast("array<string>")
    return F.when(raw.isNull() | raw.isin("", "-"), empty).otherwise(
        F.filter(pieces, lambda p: p != "")
    )


def factor_pairs(raw: Column, *, lower_keys: bool = False, keep_empty_keys: bool = False) -> Column:
    """'Group:Lean | Visit:1' -> array<struct<key,value>>, in text order, repeats kept."""
    with_colon = F.filter(_factor_pieces(raw), lambda p: F.contains(p, F.lit(":")))

    def pair(piece: Column) -> Column:
        key = strip(before_first(piece, ":"))
        return F.struct(
            (F.lower(key) if lower_keys else key).alias("key"),
            strip(after_first(piece, ":")).alias("value"),
        )

    pairs = F.transform(with_colon, pair)
    return pairs if keep_empty_keys else F.filter(pairs, lambda p: p["key"] != "")


def factors_without_colon(raw: Column) -> Column:
    """The pieces of a factor string that hold no key."""
    return F.filter(_factor_pieces(raw), lambda p: ~F.contains(p, F.lit(":")))


def last_pair_per_key(pairs: Column) -> Column:
    """Drop pairs whose key comes again later.

    Repeats are rare, so the usual row pays one linear distinctness test and the
    pairwise search runs only where a key really repeats.
    """

    def pick(ps: Column) -> Column:
        n = F.size(ps)

        def is_last(p: Column, i: Column) -> Column:
            return ~F.exists(F.slice(ps, i + 2, n), lambda q: q["key"] == p["key"])

        distinct = F.size(F.array_distinct(F.transform(ps, lambda p: p["key"]))) == n
        return F.when(distinct, ps).otherwise(F.filter(ps, is_last))

    return let(pairs, pick)


def factor_map(raw: Column, **options: bool) -> Column:
    """Factor string to map<string,string>; the last of a repeated key wins."""
    return F.map_from_entries(last_pair_per_key(factor_pairs(raw, **options)))
