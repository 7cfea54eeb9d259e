"""Registered review queries over the driver tables, each with a DuckDB oracle.

Every query reads whole tables (or plans Spark derives from them).  Oracle
texts are written independently in DuckDB's dialect; the column names and
types of both sides match so results can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lintel.functions.severity import score_clinical
from lintel.operators import clinical, reports
from lintel.plans import tables
from lintel.plans.engine import RuleEngine
from lintel.plans.tables import ENCOUNTERS_SQL, RECORDS_REVIEW_DATE, RECORDS_SQL, RECORDS_STALE_DAYS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return wrap


def with_rec(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([RECORDS_SQL, *extra]) + "\n" + body


def with_enc(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([ENCOUNTERS_SQL, *extra]) + "\n" + body


RD, SD = RECORDS_REVIEW_DATE, RECORDS_STALE_DAYS

# ---------------------------------------------------------------- clinical
CLINICAL_ORACLE_CTE = f"""dup AS (
  SELECT record_id, COUNT(*) OVER (PARTITION BY patient_id, source, field_name) AS n FROM rec
),
chk AS (
  SELECT rec.*, CASE
      WHEN value IS NULL THEN 'missing_value'
      WHEN unit IS NOT NULL AND expected_unit IS NOT NULL AND unit <> expected_unit THEN 'unit_mismatch'
      WHEN dup.n > 1 THEN 'duplicate_measurement'
      WHEN date_diff('day', data_received_date, DATE '{RD}') > {SD} THEN 'stale_data'
      WHEN ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high) THEN 'out_of_range'
    END AS issue_type
  FROM rec JOIN dup USING (record_id)
),
flagged AS (SELECT * FROM chk WHERE issue_type IS NOT NULL),
scored AS (
  SELECT flagged.*,
    CASE WHEN issue_type = 'out_of_range' AND ref_high - ref_low > 0 AND value < ref_low THEN (ref_low - value) / (ref_high - ref_low)
         WHEN issue_type = 'out_of_range' AND ref_high - ref_low > 0 AND value > ref_high THEN (value - ref_high) / (ref_high - ref_low)
         ELSE 0.0::DOUBLE END AS pct_outside
  FROM flagged
),
sev AS (
  SELECT scored.*, CASE
      WHEN issue_type IN ('missing_value', 'unit_mismatch', 'stale_data') THEN 'high'
      WHEN issue_type = 'duplicate_measurement' THEN 'medium'
      WHEN issue_type = 'out_of_range' AND pct_outside > 0.4e0 THEN 'high'
      WHEN issue_type = 'out_of_range' THEN 'medium'
      ELSE 'low' END AS severity
  FROM scored
)"""

RECORD_COLS = ("record_id, patient_id, source, field_name, value, unit, expected_unit, "
               "ref_low, ref_high, data_received_date")


def _flagged(spark, sf_dir):
    return clinical.run_checks_dataframe(tables.records(spark, sf_dir), RD, SD)


def _scored(spark, sf_dir):
    return score_clinical(_flagged(spark, sf_dir))


@register("clinical_checks", with_rec(f"SELECT {RECORD_COLS}, issue_type FROM flagged", CLINICAL_ORACLE_CTE))
def q_clinical_checks(spark, sf_dir):
    return _flagged(spark, sf_dir)


@register("clinical_checks_sql", with_rec(f"SELECT {RECORD_COLS}, issue_type FROM flagged", CLINICAL_ORACLE_CTE))
def q_clinical_checks_sql(spark, sf_dir):
    return clinical.run_checks_sql(spark, tables.records(spark, sf_dir), RD, SD)


@register("clinical_severity", with_rec(
    "SELECT record_id, source, issue_type, round(pct_outside, 4) AS pct_outside, severity FROM sev",
    CLINICAL_ORACLE_CTE))
def q_clinical_severity(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("record_id", "source", "issue_type", F.round("pct_outside", 4).alias("pct_outside"), "severity")


@register("pct_outside", with_rec(
    "SELECT record_id, round(ref_high - ref_low, 4) AS range_width, round(pct_outside, 4) AS pct_outside "
    "FROM sev WHERE issue_type = 'out_of_range'", CLINICAL_ORACLE_CTE))
def q_pct_outside(spark, sf_dir):
    s = _scored(spark, sf_dir).where(F.col("issue_type") == "out_of_range")
    return s.select("record_id", F.round("range_width", 4).alias("range_width"),
                    F.round("pct_outside", 4).alias("pct_outside"))


@register("cross_validate", with_rec(
    "SELECT 0::BIGINT AS only_dataframe, 0::BIGINT AS only_sql, COUNT(*)::BIGINT AS in_both FROM flagged",
    CLINICAL_ORACLE_CTE))
def q_cross_validate(spark, sf_dir):
    rec = tables.records(spark, sf_dir)
    return clinical.cross_validate_frame(clinical.run_checks_dataframe(rec, RD, SD),
                                         clinical.run_checks_sql(spark, rec, RD, SD))


@register("clinical_issues_long", with_rec(f"""
SELECT record_id, 'missing_value' AS issue_type FROM rec WHERE value IS NULL
UNION ALL SELECT record_id, 'unit_mismatch' FROM rec
  WHERE unit IS NOT NULL AND expected_unit IS NOT NULL AND unit <> expected_unit
UNION ALL SELECT record_id, 'duplicate_measurement' FROM dup WHERE n > 1
UNION ALL SELECT record_id, 'stale_data' FROM rec WHERE date_diff('day', data_received_date, DATE '{RD}') > {SD}
UNION ALL SELECT record_id, 'out_of_range' FROM rec
  WHERE ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high)""",
    CLINICAL_ORACLE_CTE))
def q_clinical_issues_long(spark, sf_dir):
    return clinical.run_checks_long(tables.records(spark, sf_dir), RD, SD).select("record_id", "issue_type")


@register("summary_ranked", with_rec("""
SELECT source, severity, COUNT(*) AS flagged_count,
       CAST(RANK() OVER (PARTITION BY severity ORDER BY COUNT(*) DESC) AS BIGINT) AS rank_within_severity
FROM sev GROUP BY source, severity""", CLINICAL_ORACLE_CTE))
def q_summary_ranked(spark, sf_dir):
    s = reports.summary_ranked(_scored(spark, sf_dir))
    return s.withColumn("rank_within_severity", F.col("rank_within_severity").cast("long"))


# ---------------------------------------------------------------- rule engine
ISSUE_COLS = ["issue_type", "issue_column", "rule_id", "rule_severity", "metric_value"]
ISSUE_SQL = "issue_type, issue_column, rule_id, rule_severity, metric_value"


def rule_issues(df: DataFrame, rules: list[dict], keys: list[str], **opts) -> DataFrame:
    return RuleEngine(rules, **opts).issues(df).select(*keys, *ISSUE_COLS)


def _issue_sql(keys: str, table: str, cond: str, issue_type: str, column: str, rule_id: str, severity: str,
               metric: str = "NULL") -> str:
    return (f"SELECT {keys}, '{issue_type}' AS issue_type, '{column}' AS issue_column, '{rule_id}' AS rule_id, "
            f"{severity} AS rule_severity, CAST({metric} AS DOUBLE) AS metric_value FROM {table} WHERE {cond}")


def _missing_sql(keys: str, table: str, column: str, rule_id: str, severity: str, warn: float = 0.0,
                 crit: float = 0.0) -> str:
    blank = f"({column} IS NULL OR trim(CAST({column} AS VARCHAR)) = '')"
    pct = f"(SELECT 100.0 * count_if({blank}) / count(*) FROM {table})"
    sev = f"'{severity}'" if not crit else f"CASE WHEN {pct} >= {crit} THEN 'critical' ELSE '{severity}' END"
    keep = f"{blank} AND {pct} > 0 AND {pct} >= {warn}"
    return _issue_sql(keys, table, keep, f"missing_{column}", column, rule_id, sev, f"round({pct}, 2)")


MISSING_COLS = ["value", "expected_unit", "ref_low", "ref_high"]


@register("missing_value", with_rec("\nUNION ALL ".join(
    _missing_sql("record_id", "rec", c, "missing_fields", "warning") for c in MISSING_COLS)))
def q_missing_value(spark, sf_dir):
    rules = [{"id": "missing_fields", "type": "missing_value", "column_pattern": "^(value|expected_unit|ref_low|ref_high)$"}]
    return rule_issues(tables.records(spark, sf_dir), rules, ["record_id"])


@register("missing_value_threshold", with_rec("\nUNION ALL ".join(
    _missing_sql("record_id", "rec", c, "missing_thresholds", "info", 3.0, 5.0) for c in MISSING_COLS)))
def q_missing_value_threshold(spark, sf_dir):
    rules = [{"id": "missing_thresholds", "type": "missing_value", "severity": "info",
              "column_pattern": "^(value|expected_unit|ref_low|ref_high)$",
              "threshold_warning": 3, "threshold_critical": 5}]
    return rule_issues(tables.records(spark, sf_dir), rules, ["record_id"])


def _dup_sql(keys: str, table: str, column: str, rule_id: str, severity: str, allow_nulls: bool = False) -> str:
    cte = f"(SELECT *, COUNT(*) OVER (PARTITION BY {column}) AS __n FROM {table}) d"
    cond = "__n > 1" + (f" AND {column} IS NOT NULL" if allow_nulls else "")
    return _issue_sql(keys, cte, cond, f"duplicate_{column}", column, rule_id, f"'{severity}'", "__n")


@register("duplicate_key", _dup_sql("conv_id, turn", "conversations", "conv_id", "dup_conv", "critical"))
def q_duplicate_key(spark, sf_dir):
    rules = [{"id": "dup_conv", "type": "duplicate", "column": "conv_id", "severity": "critical"}]
    return rule_issues(tables.table(spark, sf_dir, "conversations"), rules, ["conv_id", "turn"])


@register("duplicate_key_orders", _dup_sql("o_orderkey", "orders", "o_custkey", "dup_customer_orders", "warning"))
def q_duplicate_key_orders(spark, sf_dir):
    rules = [{"id": "dup_customer_orders", "type": "duplicate", "column_pattern": "custkey$"}]
    return rule_issues(tables.table(spark, sf_dir, "orders"), rules, ["o_orderkey"])


EVENTS_NULL_USER = "(SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events)"


def _events_null_user(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events")
    return ev.select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"))


@register("duplicate_key_ignore_nulls", _dup_sql("event_id", EVENTS_NULL_USER + " e", "user_id", "dup_user", "info", True))
def q_duplicate_key_ignore_nulls(spark, sf_dir):
    rules = [{"id": "dup_user", "type": "duplicate", "column": "user_id", "severity": "info", "allow_nulls": True}]
    return rule_issues(_events_null_user(spark, sf_dir), rules, ["event_id"])


@register("duplicate_key_null_group", _dup_sql("event_id", EVENTS_NULL_USER + " e", "user_id", "dup_user", "info"))
def q_duplicate_key_null_group(spark, sf_dir):
    rules = [{"id": "dup_user", "type": "duplicate", "column": "user_id", "severity": "info"}]
    return rule_issues(_events_null_user(spark, sf_dir), rules, ["event_id"])


@register("numeric_reference_range", with_rec(_issue_sql(
    "record_id", "rec", "ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high)",
    "range_check_value", "value", "ref_range", "'warning'", "value")))
def q_numeric_reference_range(spark, sf_dir):
    rules = [{"id": "ref_range", "type": "numeric_range", "column": "value", "use_reference_range": True}]
    return rule_issues(tables.records(spark, sf_dir), rules, ["record_id"])


@register("numeric_non_negative", _issue_sql("c_custkey", "customer", "c_acctbal < 0", "range_check_c_acctbal",
                                             "c_acctbal", "negative_balance", "'warning'", "c_acctbal"))
def q_numeric_non_negative(spark, sf_dir):
    rules = [{"id": "negative_balance", "type": "numeric_range", "column_pattern": "acctbal", "allow_negative": False}]
    return rule_issues(tables.table(spark, sf_dir, "customer"), rules, ["c_custkey"])


@register("numeric_min_max", _issue_sql("p_partkey", "part", "p_size < 5 OR p_size > 45", "range_check_p_size",
                                        "p_size", "size_bounds", "'critical'", "p_size"))
def q_numeric_min_max(spark, sf_dir):
    rules = [{"id": "size_bounds", "type": "numeric_range", "column": "p_size", "min_value": 5, "max_value": 45,
              "severity": "critical"}]
    return rule_issues(tables.table(spark, sf_dir, "part"), rules, ["p_partkey"])


LI_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@register("numeric_range_combined", "\nUNION ALL ".join([
    _issue_sql(LI_KEYS, "lineitem", f"{c} < 0 OR {c} < 0.02e0 OR {c} > 40.0e0", f"range_check_{c}", c,
               "line_bounds", "'warning'", c) for c in ("l_quantity", "l_discount")]))
def q_numeric_range_combined(spark, sf_dir):
    rules = [{"id": "line_bounds", "type": "numeric_range", "column_pattern": "^l_(quantity|discount)$",
              "allow_negative": False, "min_value": 0.02, "max_value": 40}]
    return rule_issues(tables.table(spark, sf_dir, "lineitem"), rules, LI_KEYS.split(", "))


@register("outlier_iqr", """WITH q AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL
)
""" + _issue_sql("event_id", "events, q", "value < q1 - 1.5e0 * (q3 - q1) OR value > q3 + 1.5e0 * (q3 - q1)",
                 "outlier_value", "value", "value_iqr", "'info'", "value"))
def q_outlier_iqr(spark, sf_dir):
    rules = [{"id": "value_iqr", "type": "outlier", "column": "value", "severity": "info"}]
    return rule_issues(tables.table(spark, sf_dir, "events"), rules, ["event_id"])


@register("outlier_fixed_bounds", _issue_sql(LI_KEYS, "lineitem",
                                             "l_extendedprice < 1000.0e0 OR l_extendedprice > 90000.0e0",
                                             "outlier_l_extendedprice", "l_extendedprice", "price_bounds", "'info'",
                                             "l_extendedprice"))
def q_outlier_fixed_bounds(spark, sf_dir):
    rules = [{"id": "price_bounds", "type": "outlier", "column": "l_extendedprice", "severity": "info",
              "lower_bound": 1000, "upper_bound": 90000}]
    return rule_issues(tables.table(spark, sf_dir, "lineitem"), rules, LI_KEYS.split(", "))


EV_REVIEW = "2024-01-20"


@register("date_future", _issue_sql("event_id", "events", f"CAST(ts AS DATE) > DATE '{EV_REVIEW}'", "future_ts", "ts",
                                    "future_events", "'critical'"))
def q_date_future(spark, sf_dir):
    rules = [{"id": "future_events", "type": "date_range", "column": "ts", "check_future": True, "severity": "critical",
              "review_date": EV_REVIEW}]
    return rule_issues(tables.table(spark, sf_dir, "events"), rules, ["event_id"])


@register("date_stale", _issue_sql("event_id", "events", f"date_diff('day', CAST(ts AS DATE), DATE '{EV_REVIEW}') > 14",
                                   "stale_ts", "ts", "stale_events", "'warning'",
                                   f"date_diff('day', CAST(ts AS DATE), DATE '{EV_REVIEW}')"))
def q_date_stale(spark, sf_dir):
    rules = [{"id": "stale_events", "type": "date_range", "column_pattern": "^ts$", "max_age_days": 14}]
    return rule_issues(tables.table(spark, sf_dir, "events"), rules, ["event_id"], review_date=EV_REVIEW)


def _card_sql(column: str) -> str:
    n = f"(SELECT COUNT(DISTINCT {column}) + MAX(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) FROM events)"
    return _issue_sql("event_id", "events", f"{n} > 100", f"high_cardinality_{column}", column, "card", "'warning'", n)


@register("cardinality", _card_sql("event_type") + "\nUNION ALL " + _card_sql("user_id"))
def q_cardinality(spark, sf_dir):
    rules = [{"id": "card", "type": "cardinality", "column_pattern": "^(event_type|user_id)$", "max_unique": 100}]
    return rule_issues(tables.table(spark, sf_dir, "events"), rules, ["event_id"])


@register("unit_mismatch", with_rec(_issue_sql(
    "record_id", "rec", "unit IS NOT NULL AND expected_unit IS NOT NULL AND unit <> expected_unit",
    "unit_mismatch_unit", "unit", "unit_mismatch_unit", "'warning'")))
def q_unit_mismatch(spark, sf_dir):
    rules = [{"type": "unit_mismatch"}]
    return rule_issues(tables.records(spark, sf_dir), rules, ["record_id"])


@register("allowed_values", _issue_sql("o_orderkey", "orders",
                                       "o_orderstatus IS NOT NULL AND lower(o_orderstatus) NOT IN ('o', 'f')",
                                       "invalid_allowed_value_o_orderstatus", "o_orderstatus", "status_codes",
                                       "'warning'"))
def q_allowed_values(spark, sf_dir):
    rules = [{"id": "status_codes", "type": "allowed_values", "allowed_values": ["O", "F"]}]
    return rule_issues(tables.table(spark, sf_dir, "orders"), rules, ["o_orderkey"])


@register("format_check", _issue_sql("p_partkey", "part",
                                     "p_brand IS NOT NULL AND NOT regexp_matches(p_brand, '^Brand#[0-9]$')",
                                     "invalid_format_p_brand", "p_brand", "brand_format", "'warning'"))
def q_format_check(spark, sf_dir):
    rules = [{"id": "brand_format", "type": "format_check", "column": "p_brand", "regex": "^Brand#[0-9]$"}]
    return rule_issues(tables.table(spark, sf_dir, "part"), rules, ["p_partkey"])


ICD_REGEX = r"^[A-TV-Z][0-9][0-9A-Z](\.[0-9A-Z]{1,4})?$"
NPI_REGEX = r"^[0-9]{10}$"
PART_CODES_SQL = """(SELECT p_partkey,
    concat(chr(CAST(65 + p_partkey % 26 AS INTEGER)), CAST(p_partkey % 10 AS VARCHAR),
           CAST((p_partkey // 10) % 10 AS VARCHAR),
           CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 4 = 1 THEN concat('.', CAST(p_partkey % 97 AS VARCHAR))
                WHEN p_partkey % 4 = 2 THEN concat('-', CAST(p_partkey % 7 AS VARCHAR)) ELSE '.x' END) AS icd_code
  FROM part) pc"""
SUPP_NPI_SQL = """(SELECT s_suppkey,
    CASE WHEN s_suppkey % 9 = 0 THEN CAST(s_suppkey AS VARCHAR)
         ELSE lpad(CAST(s_suppkey * 7919 AS VARCHAR), 10, '0') END AS npi
  FROM supplier) sn"""


def part_codes(spark, sf_dir):
    k = F.col("p_partkey")
    tail = (F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.concat(F.lit("."), (k % 97).cast("string")))
            .when(k % 4 == 2, F.concat(F.lit("-"), (k % 7).cast("string"))).otherwise(F.lit(".x")))
    return tables.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.chr((F.lit(65) + k % 26).cast("long")), (k % 10).cast("string"),
                 (F.floor(k / 10) % 10).cast("string"), tail).alias("icd_code"))


def supplier_npi(spark, sf_dir):
    k = F.col("s_suppkey")
    return tables.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(k % 9 == 0, k.cast("string")).otherwise(F.lpad((k * 7919).cast("string"), 10, "0")).alias("npi"))


@register("format_icd", _issue_sql("p_partkey", PART_CODES_SQL,
                                   f"icd_code IS NOT NULL AND NOT regexp_matches(icd_code, '{ICD_REGEX}')",
                                   "invalid_format_icd_code", "icd_code", "invalid_icd_code_format", "'warning'"))
def q_format_icd(spark, sf_dir):
    rules = [{"id": "invalid_icd_code_format", "type": "format_check", "column_pattern": ".*icd.*",
              "regex": ICD_REGEX.replace("\\\\", "\\")}]
    return rule_issues(part_codes(spark, sf_dir), rules, ["p_partkey"])


@register("format_npi", _issue_sql("s_suppkey", SUPP_NPI_SQL,
                                   f"npi IS NOT NULL AND NOT regexp_matches(npi, '{NPI_REGEX}')",
                                   "invalid_format_npi", "npi", "invalid_npi_format", "'warning'"))
def q_format_npi(spark, sf_dir):
    rules = [{"id": "invalid_npi_format", "type": "format_check", "column_pattern": ".*npi.*", "regex": NPI_REGEX}]
    return rule_issues(supplier_npi(spark, sf_dir), rules, ["s_suppkey"])


@register("date_order", with_enc(_issue_sql(
    "encounter_ref", "enc", "CAST(discharge_date AS DATE) < CAST(admission_date AS DATE)",
    "invalid_date_order_admission_date_discharge_date", "discharge_date", "admission_before_discharge",
    "'critical'")))
def q_date_order(spark, sf_dir):
    rules = [{"id": "admission_before_discharge", "type": "date_order", "severity": "critical",
              "start_pattern": ".*admission.*|.*admit.*|.*start.*", "end_pattern": ".*discharge.*|.*end.*"}]
    return rule_issues(tables.encounters(spark, sf_dir), rules, ["encounter_ref"])


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# Registration of the remaining query groups (modules import helpers from here).
from lintel.plans import catalog_reports  # noqa: E402,F401
from lintel.plans import catalog_profile  # noqa: E402,F401
from lintel.plans import catalog_packs  # noqa: E402,F401
from lintel.plans import catalog_sources  # noqa: E402,F401
