"""Builders that turn ordered rule tables into single Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Case-insensitive, with Unicode word boundaries whatever the JVM version.
FLAGS = "(?iU)"


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    """One regex scan for a whole class of patterns."""
    return text.rlike(FLAGS + "(?:" + "|".join(patterns) + ")")


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Plain (case-sensitive) substring test for several words in one scan of the text."""
    return text.rlike("|".join(re.escape(word) for word in words))


def first_class(tests: Iterable[tuple[str, Column]]) -> Column:
    """Label of the first test that holds, else NULL. CASE WHEN is ordered and lazy."""
    chain = F
    for label, test in tests:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(None).cast("string"))


def all_classes(tests: Iterable[tuple[str, Column]]) -> Column:
    """Distinct labels of all tests that hold, in rule order."""
    hits = F.array(*[F.when(test, F.lit(label)) for label, test in tests])
    return F.array_distinct(F.array_compact(hits))
