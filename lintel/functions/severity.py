"""Severity as native column expressions; the caller says which kind of issues it has.

``score_rules`` is for rule-engine issues, ``score_clinical`` for the fixed
clinical check.  Neither looks at which columns happen to be there, so an input
column called ``severity`` or ``rule_severity`` never decides anything (both
check paths rename such columns first).

Fixed values: ``RULE_LEVELS`` (any other rule severity, null too, is medium),
``ISSUE_LEVELS`` (an out-of-range value is high beyond the threshold, else
medium; any other issue is low).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from lintel import config

RULE_LEVELS = {"critical": "high", "high": "high", "info": "low", "low": "low"}
ISSUE_LEVELS = {"missing_value": "high", "unit_mismatch": "high", "stale_data": "high",
                "duplicate_measurement": "medium"}


def _level(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), key)


def normalised_rule_severity(rule_severity: Column) -> Column:
    return F.coalesce(_level(RULE_LEVELS, F.lower(rule_severity)), F.lit("medium"))


def range_width() -> Column:
    return F.col("ref_high") - F.col("ref_low")


def pct_outside() -> Column:
    """How many range widths an out-of-range value lies outside its range; 0.0 for any other row."""
    beyond = F.greatest(F.col("ref_low") - F.col("value"), F.col("value") - F.col("ref_high"), F.lit(0.0))
    applies = (F.col("issue_type") == "out_of_range") & (range_width() > 0)
    return F.when(applies, beyond / range_width()).otherwise(F.lit(0.0))


def clinical_severity(issue_type: Column, pct: Column, threshold: float = config.HIGH_SEVERITY_THRESHOLD) -> Column:
    by_distance = F.when(pct > threshold, "high").otherwise("medium")
    return F.coalesce(_level(ISSUE_LEVELS, issue_type), F.when(issue_type == "out_of_range", by_distance), F.lit("low"))


def score_rules(issues: DataFrame) -> DataFrame:
    return issues.withColumn("severity", normalised_rule_severity(F.col("rule_severity")))


def score_clinical(flagged: DataFrame, threshold: float = config.HIGH_SEVERITY_THRESHOLD) -> DataFrame:
    scored = flagged.withColumns({"range_width": range_width(), "pct_outside": pct_outside()})
    return scored.withColumn("severity", clinical_severity(F.col("issue_type"), F.col("pct_outside"), threshold))
