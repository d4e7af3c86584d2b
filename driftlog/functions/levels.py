"""Log levels: extraction from a raw line and canonical form of a given level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): level words tried in this order, default INFO.
LEVEL_WORDS = ["ERROR", "WARN", "INFO", "DEBUG", "FATAL"]
DEFAULT_LEVEL = "INFO"

# The Unicode White_Space set (what a Unicode-aware TrimSpace removes).
UNICODE_SPACE_CLASS = (
    "[\\t\\n\\x{0B}\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)


def ascii_ci_pattern(word: str) -> str:
    """'ERROR' -> '[Ee][Rr][Rr][Oo][Rr]': ASCII-only case folding, identical in Java and RE2."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


def extract_level(line: Column) -> Column:
    """First level word contained in the line (ASCII case-insensitive), else INFO."""
    expr = F.lit(DEFAULT_LEVEL)
    for word in reversed(LEVEL_WORDS):
        expr = F.when(line.rlike(ascii_ci_pattern(word)), F.lit(word)).otherwise(expr)
    return F.when(F.coalesce(line, F.lit("")) == "", F.lit(DEFAULT_LEVEL)).otherwise(expr)


def trim_unicode_space(c: Column) -> Column:
    """Strip leading/trailing Unicode white space (plain trim() strips only ' ')."""
    return F.regexp_replace(c, f"\\A{UNICODE_SPACE_CLASS}+|{UNICODE_SPACE_CLASS}+\\z", "")


def canonical_level(level: Column) -> Column:
    """Trim, uppercase; empty becomes INFO; unknown words pass through."""
    up = F.upper(trim_unicode_space(F.coalesce(level, F.lit(""))))
    return F.when(up == "", F.lit(DEFAULT_LEVEL)).otherwise(up)
