"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from driftlog.functions.levels import canonical_level, extract_level, trim_unicode_space
from driftlog.functions.text import contains_ci, equal_fold, text_match, tokens, query_terms
from driftlog.functions.ids import log_id
from driftlog.functions.jsonx import is_single_json, json_quote, dead_letter_payload
from driftlog.functions.timefmt import rfc3339_text, parse_rfc3339, format_rfc3339, floor_second, utc_day
from driftlog.functions.keys import partition_key, index_name, archive_path

__all__ = [
    "canonical_level", "extract_level", "trim_unicode_space",
    "contains_ci", "equal_fold", "text_match", "tokens", "query_terms",
    "log_id",
    "is_single_json", "json_quote", "dead_letter_payload",
    "rfc3339_text", "parse_rfc3339", "format_rfc3339", "floor_second", "utc_day",
    "partition_key", "index_name", "archive_path",
]
