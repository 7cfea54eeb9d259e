"""Plan-time column resolution for rules (names are metadata, not data)."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from lintel import config

logger = logging.getLogger("lintel")


def match_columns(pattern: str | None, columns: Iterable[str]) -> list[str]:
    """Columns selected by a rule pattern.

    An exact (case-sensitive) name wins; otherwise the pattern is a
    case-insensitive regular-expression *search* over each name.  An invalid
    pattern selects nothing.
    """
    cols = list(columns)
    if pattern is None:
        return []
    if pattern in cols:
        return [pattern]
    try:
        regex = re.compile(pattern, re.IGNORECASE)
    except re.error:
        logger.warning("invalid column pattern skipped: %s", pattern)
        return []
    return [c for c in cols if regex.search(c)]


def target_columns(rule: dict, columns: Sequence[str], default_pattern: str = ".*") -> list[str]:
    """``column`` beats ``column_pattern`` beats the rule type's default pattern."""
    name = rule.get("column")
    if name:
        return [name] if name in columns else []
    return match_columns(rule.get("column_pattern", default_pattern), columns)


def protect_reserved(df: DataFrame) -> DataFrame:
    """Rename input columns that clash with outputs, in any letter case (``severity`` -> ``input_severity``)."""
    used = {c.lower() for c in df.columns}
    renamed = {}
    for c in df.columns:
        if c.lower() in config.RESERVED_COLUMNS:
            new = config.RENAMED_INPUT_PREFIX + c
            while new.lower() in used:
                new = config.RENAMED_INPUT_PREFIX + new
            used.add(new.lower())
            renamed[c] = new
    return df.withColumnsRenamed(renamed) if renamed else df
