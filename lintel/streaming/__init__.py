"""Row-local rules on streaming DataFrames.

The rule engine's row pass is a projection plus a generator, so the same
compiled checks run unchanged on a ``readStream`` source.  Rules that need a
whole-table statistic (missing-value ratios, duplicate counts, distinct
counts, quartiles) have no meaning on an unbounded stream and are rejected;
run those on the landed table in batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lintel import config
from lintel.plans.engine import RuleEngine

TABLE_RULES = {"missing_value", "duplicate", "cardinality"}


def needs_table_statistics(rule: dict) -> bool:
    kind = rule.get("type")
    if kind in TABLE_RULES:
        return True
    if kind == "outlier":
        return not (rule.get("lower_bound") is not None and rule.get("upper_bound") is not None)
    return False


def review_stream(stream: DataFrame, rules: Sequence[dict], review_date: str = config.REVIEW_DATE) -> DataFrame:
    """Streaming DataFrame of issue rows (input columns + issue columns) for row-local rules."""
    active = [r for r in rules if r.get("enabled", True)]
    bad = [r.get("id", r.get("type")) for r in active if needs_table_statistics(r)]
    if bad:
        raise ValueError(f"rules need whole-table statistics and cannot run on a stream: {bad}")
    return RuleEngine(active, review_date=review_date).issues(stream)
