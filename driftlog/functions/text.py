"""Text predicates: case-insensitive containment, case-folded equality, full-text terms."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a term is a maximal run of letters, digits and '_' (after lower-casing).
TERM_SPLIT = "[^\\p{L}\\p{N}_]+"
_PY_TERM_SPLIT = re.compile(r"[^\w]+")


def tokens(c: Column) -> Column:
    """Lower-cased terms of a text column, empty pieces removed."""
    return F.array_remove(F.split(F.lower(c), TERM_SPLIT), "")


def query_terms(q: str) -> list[str]:
    """Terms of a search string on the driver (a request literal, never data)."""
    return sorted({t for t in _PY_TERM_SPLIT.split(q.lower()) if t})


def text_match(message_terms: Column, terms: Iterable[str]) -> Column:
    """Any query term among the message terms (match query, no scoring)."""
    terms = list(terms)
    if not terms:
        return F.lit(False)
    return F.arrays_overlap(message_terms, F.array(*[F.lit(t) for t in terms]))


def contains_ci(text: Column, needle: Column) -> Column:
    """Substring test after lower-casing both sides; empty needle matches anything."""
    return F.contains(F.lower(text), F.lower(needle))


def equal_fold(a: Column, b: Column) -> Column:
    """Case-folded equality. lower(upper(x)) would be simplified by the optimizer, so test both."""
    return (F.length(a) == F.length(b)) & ((F.lower(a) == F.lower(b)) | (F.upper(a) == F.upper(b)))
