"""Run defaults.

Fixed values (they must equal the reviewed application's for equal results):
review date 2026-08-23, stale after 14 days, an out-of-range value is high
severity when it lies more than 0.4 range widths outside, missing-value
thresholds default to 0, duplicate keys default to ``.*id$|.*key$``,
cardinality limit defaults to 100, IQR multiplier defaults to 1.5,
default rule severity is "warning".
"""

from __future__ import annotations

REVIEW_DATE = "2026-08-23"
STALE_DATA_DAYS = 14
HIGH_SEVERITY_THRESHOLD = 0.4
DEFAULT_RULE_SEVERITY = "warning"
DEFAULT_MAX_UNIQUE = 100
DEFAULT_IQR_MULTIPLIER = 1.5

# Relative error of the approximate quartiles (the reviewed application calls
# approxQuantile with 0.05, i.e. percentile_approx accuracy 20).
APPROX_QUANTILE_ERROR = 0.05

# Output columns the engine reserves; clashing input columns are renamed with
# this prefix so an input column can never masquerade as a result (K10).
ISSUE_COLUMNS = ("issue_type", "issue_column", "rule_id", "rule_severity", "metric_value")
RESERVED_COLUMNS = ISSUE_COLUMNS + ("severity", "pct_outside", "range_width", "drafted_query", "issues")
RENAMED_INPUT_PREFIX = "input_"
