"""Registered queries: rule packs over the driver tables, auto review, typed ingest, metadata."""

from __future__ import annotations


from lintel import packs
from lintel.plans import tables
from lintel.plans.catalog import (ISSUE_COLS, RD, _dup_sql, _issue_sql, _missing_sql, register, with_rec)
from lintel.plans.engine import RuleEngine
from lintel.plans.review import Review
from lintel.sources import io

# ---------------------------------------------------------------- DuckDB twins of the derived tables
ENC_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE concat('EN-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) END AS encounter_id,
    o_orderdate AS admission_date, l_shipdate AS discharge_date,
    CASE WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'partial' END AS status,
    CASE WHEN l_linenumber = 1 THEN 'M' WHEN l_linenumber = 2 THEN 'F' WHEN l_linenumber = 3 THEN 'female'
         WHEN l_linenumber = 4 THEN 'X' END AS gender,
    concat(chr(CAST(65 + l_partkey % 26 AS INTEGER)), CAST(l_partkey % 10 AS VARCHAR), CAST((l_partkey // 10) % 10 AS VARCHAR),
           CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat('.', CAST(l_partkey % 7 AS VARCHAR)) END) AS icd_code,
    CASE WHEN l_suppkey % 9 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE lpad(CAST(l_suppkey * 7919 AS VARCHAR), 10, '0') END AS npi,
    CAST(l_quantity * 3 - 10 AS INTEGER) AS age, l_discount * 1000 AS bmi, l_extendedprice / 300 AS heart_rate,
    l_tax * 4000 AS systolic, l_extendedprice * (1 - l_discount) - 5000 AS paid_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TXN_SQL = """(SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('T-', CAST(o_orderkey AS VARCHAR)) END AS transaction_id,
    o_custkey AS account_id,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
    o_orderdate AS posted_date, o_orderstatus AS status
  FROM orders)"""

STOCK_SQL = """(SELECT p_partkey,
    CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE concat('SKU-', CAST(p_partkey AS VARCHAR)) END AS sku,
    CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE p_size - 5 END AS quantity,
    DATE '1996-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS updated, p_type AS category
  FROM part)"""

WEB_SQL = """(SELECT event_id,
    'S-' || CAST(CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE ts END AS event_timestamp,
    value * 1000 AS duration, value - 5 AS value
  FROM events)"""

CUST_SQL = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""


def _cte(name: str, text: str) -> str:
    return f"{name} AS {text}"


def _pack_issues(df, pack_id: str, keys: list[str], review_date: str):
    rules = packs.get_pack(pack_id)["rules"]
    return RuleEngine(rules, review_date=review_date).issues(df).select(*keys, *ISSUE_COLS)


def _outlier_sql(keys: str, table: str, column: str, mult: float, rule_id: str, severity: str) -> str:
    q = (f"(SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {table} "
         f"WHERE {column} IS NOT NULL) q")
    cond = f"{column} < q1 - {mult}e0 * (q3 - q1) OR {column} > q3 + {mult}e0 * (q3 - q1)"
    return _issue_sql(keys, f"{table}, {q}", cond, f"outlier_{column}", column, rule_id, f"'{severity}'", column)


def _future_sql(keys, table, column, rd, rule_id, severity):
    return _issue_sql(keys, table, f"CAST({column} AS DATE) > DATE '{rd}'", f"future_{column}", column, rule_id,
                      f"'{severity}'")


def _stale_sql(keys, table, column, rd, days, rule_id, severity):
    age = f"date_diff('day', CAST({column} AS DATE), DATE '{rd}')"
    return _issue_sql(keys, table, f"{age} > {days}", f"stale_{column}", column, rule_id, f"'{severity}'", age)


def _range_sql(keys, table, column, cond, rule_id, severity):
    return _issue_sql(keys, table, cond, f"range_check_{column}", column, rule_id, f"'{severity}'", column)


# ---------------------------------------------------------------- clinical pack
REC_KEYS = "record_id"


@register("pack_clinical", with_rec("\nUNION ALL ".join([
    _missing_sql(REC_KEYS, "rec", "record_id", "missing_id", "critical"),
    _missing_sql(REC_KEYS, "rec", "patient_id", "missing_id", "critical"),
    _missing_sql(REC_KEYS, "rec", "value", "missing_clinical_measurement", "warning", 1.0, 20.0),
    _dup_sql(REC_KEYS, "rec", "record_id", "duplicate_patient_or_record", "critical"),
    _range_sql(REC_KEYS, "rec", "value", "ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high)",
               "reference_range_violation", "warning"),
    _issue_sql(REC_KEYS, "rec", "unit IS NOT NULL AND expected_unit IS NOT NULL AND unit <> expected_unit",
               "unit_mismatch_unit", "unit", "unit_mismatch", "'warning'"),
    _future_sql(REC_KEYS, "rec", "data_received_date", RD, "future_clinical_date", "critical"),
    _stale_sql(REC_KEYS, "rec", "data_received_date", RD, 365, "stale_clinical_data", "warning"),
    _outlier_sql(REC_KEYS, "rec", "value", 3.0, "lab_value_outlier", "info"),
])))
def q_pack_clinical(spark, sf_dir):
    return _pack_issues(tables.records(spark, sf_dir), "clinical", ["record_id"], RD)


ENC_REVIEW = "1998-06-01"
ENC_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


ENC_UNION = "\nUNION ALL ".join([
    _missing_sql(ENC_KEYS, "enc", "encounter_id", "missing_id", "critical"),
    _dup_sql(ENC_KEYS, "enc", "encounter_id", "duplicate_patient_or_record", "critical"),
    _future_sql(ENC_KEYS, "enc", "admission_date", ENC_REVIEW, "future_clinical_date", "critical"),
    _future_sql(ENC_KEYS, "enc", "discharge_date", ENC_REVIEW, "future_clinical_date", "critical"),
    _stale_sql(ENC_KEYS, "enc", "admission_date", ENC_REVIEW, 365, "stale_clinical_data", "warning"),
    _stale_sql(ENC_KEYS, "enc", "discharge_date", ENC_REVIEW, 365, "stale_clinical_data", "warning"),
    _range_sql(ENC_KEYS, "enc", "age", "age < 0.0e0 OR age > 120.0e0", "invalid_age", "critical"),
    _issue_sql(ENC_KEYS, "enc", "gender IS NOT NULL AND lower(gender) NOT IN ('m', 'f', 'male', 'female', 'other', 'unknown', 'u')",
               "invalid_allowed_value_gender", "gender", "invalid_gender_code", "'warning'"),
    _issue_sql(ENC_KEYS, "enc", "status IS NOT NULL AND lower(status) NOT IN ('active', 'inactive', 'open', 'closed', "
               "'complete', 'completed', 'pending', 'cancelled', 'discharged', 'admitted')",
               "invalid_allowed_value_status", "status", "invalid_status_code", "'warning'"),
    _issue_sql(ENC_KEYS, "enc", "icd_code IS NOT NULL AND NOT regexp_matches(icd_code, '^[A-TV-Z][0-9][0-9A-Z](\\.[0-9A-Z]{1,4})?$')",
               "invalid_format_icd_code", "icd_code", "invalid_icd_code_format", "'warning'"),
    _issue_sql(ENC_KEYS, "enc", "npi IS NOT NULL AND NOT regexp_matches(npi, '^[0-9]{10}$')",
               "invalid_format_npi", "npi", "invalid_npi_format", "'warning'"),
    _issue_sql(ENC_KEYS, "enc", "CAST(discharge_date AS DATE) < CAST(admission_date AS DATE)",
               "invalid_date_order_admission_date_discharge_date", "discharge_date", "admission_before_discharge",
               "'critical'"),
    _range_sql(ENC_KEYS, "enc", "bmi", "bmi < 10.0e0 OR bmi > 80.0e0", "invalid_bmi", "warning"),
    _range_sql(ENC_KEYS, "enc", "heart_rate", "heart_rate < 20.0e0 OR heart_rate > 250.0e0", "invalid_heart_rate", "warning"),
    _range_sql(ENC_KEYS, "enc", "systolic", "systolic < 30.0e0 OR systolic > 300.0e0", "invalid_blood_pressure", "warning"),
    _range_sql(ENC_KEYS, "enc", "paid_amount", "paid_amount < 0", "negative_healthcare_amount", "warning"),
])


@register("pack_clinical_encounters", f"WITH {_cte('enc', ENC_SQL)}\n" + ENC_UNION)
def q_pack_clinical_encounters(spark, sf_dir):
    return _pack_issues(tables.clinical_encounters(spark, sf_dir), "clinical", ENC_KEYS.split(", "), ENC_REVIEW)


# ---------------------------------------------------------------- financial, inventory, web, generic
TXN_REVIEW = "1998-01-01"


@register("pack_financial", f"WITH {_cte('txn', TXN_SQL)}\n" + "\nUNION ALL ".join([
    _missing_sql("o_orderkey", "txn", "transaction_id", "missing_transaction_id", "critical"),
    _missing_sql("o_orderkey", "txn", "account_id", "missing_transaction_id", "critical"),
    _missing_sql("o_orderkey", "txn", "amount", "missing_amount", "critical", 0.0, 1.0),
    _range_sql("o_orderkey", "txn", "amount", "amount < 0", "negative_amount", "warning"),
    _dup_sql("o_orderkey", "txn", "transaction_id", "duplicate_transaction", "critical"),
    _dup_sql("o_orderkey", "txn", "account_id", "duplicate_transaction", "critical"),
    _future_sql("o_orderkey", "txn", "posted_date", TXN_REVIEW, "future_date", "warning"),
    _outlier_sql("o_orderkey", "txn", "amount", 2.0, "unusual_amount", "info"),
]))
def q_pack_financial(spark, sf_dir):
    return _pack_issues(tables.transactions(spark, sf_dir), "financial", ["o_orderkey"], TXN_REVIEW)


STOCK_REVIEW = "1999-01-01"


@register("pack_inventory", f"WITH {_cte('stk', STOCK_SQL)}\n" + "\nUNION ALL ".join([
    _missing_sql("p_partkey", "stk", "sku", "missing_sku", "critical"),
    _missing_sql("p_partkey", "stk", "quantity", "missing_quantity", "critical"),
    _range_sql("p_partkey", "stk", "quantity", "quantity < 0", "negative_quantity", "critical"),
    _dup_sql("p_partkey", "stk", "sku", "duplicate_sku_location", "warning"),
    _stale_sql("p_partkey", "stk", "updated", STOCK_REVIEW, 730, "old_records", "info"),
]))
def q_pack_inventory(spark, sf_dir):
    return _pack_issues(tables.stock(spark, sf_dir), "inventory", ["p_partkey"], STOCK_REVIEW)


WEB_REVIEW = "2024-01-20"


@register("pack_web_analytics", f"WITH {_cte('web', WEB_SQL)}\n" + "\nUNION ALL ".join([
    _missing_sql("event_id", "web", "event_id", "missing_event_id", "critical"),
    _missing_sql("event_id", "web", "session_id", "missing_event_id", "critical"),
    _missing_sql("event_id", "web", "user_id", "missing_event_id", "critical"),
    _missing_sql("event_id", "web", "event_timestamp", "missing_timestamp", "critical"),
    _future_sql("event_id", "web", "event_timestamp", WEB_REVIEW, "future_event", "critical"),
    _range_sql("event_id", "web", "duration", "duration < 0", "negative_metric", "warning"),
    _range_sql("event_id", "web", "value", "value < 0", "negative_metric", "warning"),
    _dup_sql("event_id", "web", "event_id", "duplicate_event", "info"),
    _range_sql("event_id", "web", "duration", "duration > 86400.0e0", "unrealistic_duration", "warning"),
]))
def q_pack_web_analytics(spark, sf_dir):
    return _pack_issues(tables.web_events(spark, sf_dir), "web_analytics", ["event_id"], WEB_REVIEW)


@register("pack_generic", f"WITH {_cte('cust', CUST_SQL)}\n" + "\nUNION ALL ".join(
    [_missing_sql("c_custkey", "cust", c, "missing_values", "warning", 10.0, 50.0)
     for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    + [_dup_sql("c_custkey", "cust", c, "duplicates", "warning") for c in ("c_custkey", "c_nationkey")]))
def q_pack_generic(spark, sf_dir):
    return _pack_issues(tables.customers_with_gaps(spark, sf_dir), "generic", ["c_custkey"], RD)


# ---------------------------------------------------------------- auto review (classify -> pack -> rules)
@register("auto_review", f"WITH {_cte('txn', TXN_SQL)}\n" + "\nUNION ALL ".join([
    _missing_sql("o_orderkey", "txn", "transaction_id", "missing_transaction_id", "critical"),
    _missing_sql("o_orderkey", "txn", "amount", "missing_amount", "critical", 0.0, 1.0),
    _range_sql("o_orderkey", "txn", "amount", "amount < 0", "negative_amount", "warning"),
    _dup_sql("o_orderkey", "txn", "transaction_id", "duplicate_transaction", "critical"),
    _dup_sql("o_orderkey", "txn", "account_id", "duplicate_transaction", "critical"),
    _future_sql("o_orderkey", "txn", "posted_date", "2026-08-23", "future_date", "warning"),
    _outlier_sql("o_orderkey", "txn", "amount", 2.0, "unusual_amount", "info"),
]))
def q_auto_review(spark, sf_dir):
    """No rules given: the table is classified (financial here) and that pack is run."""
    review = Review(tables.transactions(spark, sf_dir), engine_options={"quantiles": "exact"})
    return review.flagged().select("o_orderkey", *ISSUE_COLS)


# ---------------------------------------------------------------- ingest and metadata
REC_TEXT_SQL = """rtext AS (
  SELECT rec.*, CAST(regexp_extract(record_id, '^E-([0-9]+)$', 1) AS BIGINT) AS eid FROM rec
)"""


@register("typed_ingest", with_rec("""SELECT record_id, patient_id, source, field_name,
  CASE WHEN eid % 53 = 0 THEN NULL ELSE value END AS value, unit, expected_unit, ref_low,
  CAST(NULL AS DOUBLE) AS ref_high,
  CASE WHEN eid % 59 = 0 THEN NULL ELSE data_received_date END AS data_received_date
FROM rtext""", REC_TEXT_SQL))
def q_typed_ingest(spark, sf_dir):
    return io.conform(tables.records_text(spark, sf_dir), strict=False)


@register("schema_conformance", with_rec("""SELECT * FROM (VALUES
  ('record_id', 'string', 'string', TRUE, (SELECT COUNT(record_id) FROM rtext), 0),
  ('patient_id', 'string', 'string', TRUE, (SELECT COUNT(patient_id) FROM rtext), 0),
  ('source', 'string', 'string', TRUE, (SELECT COUNT(source) FROM rtext), 0),
  ('field_name', 'string', 'string', TRUE, (SELECT COUNT(field_name) FROM rtext), 0),
  ('value', 'double', 'string', TRUE, (SELECT COUNT(*) FILTER (WHERE eid % 53 = 0 OR value IS NOT NULL) FROM rtext),
     (SELECT COUNT(*) FILTER (WHERE eid % 53 = 0) FROM rtext)),
  ('unit', 'string', 'string', TRUE, (SELECT COUNT(unit) FROM rtext), 0),
  ('expected_unit', 'string', 'string', TRUE, (SELECT COUNT(expected_unit) FROM rtext), 0),
  ('ref_low', 'double', 'string', TRUE, (SELECT COUNT(ref_low) FROM rtext), 0),
  ('ref_high', 'double', NULL, FALSE, 0, 0),
  ('data_received_date', 'date', 'string', TRUE, (SELECT COUNT(*) FROM rtext),
     (SELECT COUNT(*) FILTER (WHERE eid % 59 = 0) FROM rtext))
) t("column", expected_type, actual_type, present, non_null, cast_failures)""", REC_TEXT_SQL))
def q_schema_conformance(spark, sf_dir):
    return io.schema_conformance(tables.records_text(spark, sf_dir))


RUN_FLAGGED = """flagged AS (
  SELECT record_id FROM rec
  LEFT JOIN (SELECT patient_id, source, field_name, COUNT(*) AS n FROM rec GROUP BY ALL) d
    ON rec.patient_id IS NOT DISTINCT FROM d.patient_id AND rec.source IS NOT DISTINCT FROM d.source
   AND rec.field_name IS NOT DISTINCT FROM d.field_name
  WHERE value IS NULL OR (unit IS NOT NULL AND expected_unit IS NOT NULL AND unit <> expected_unit) OR d.n > 1
     OR date_diff('day', data_received_date, DATE '""" + RD + """') > 14
     OR (ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high))
)"""


@register("run_metadata", with_rec("""SELECT TRUE AS clinical_mode, CAST(NULL AS VARCHAR) AS rule_pack, (SELECT COUNT(*) FROM rec) AS total_records,
       COUNT(*) AS issues, COUNT(*) AS flagged_records, (SELECT COUNT(*) FROM rec) - COUNT(*) AS clear_records
FROM flagged""", RUN_FLAGGED))
def q_run_metadata(spark, sf_dir):
    review = Review(tables.records(spark, sf_dir), review_date=RD, stale_days=tables.RECORDS_STALE_DAYS)
    return review.metadata()


# Reviewer messages over encounter issues: every message case, and the fallbacks for tables
# without record_id / id / patient_id / field_name.
def _enc_msg_sql() -> str:
    from lintel.plans.catalog_reports import message_sql
    msg = message_sql("issue_type", "coalesce(issue_column, 'the flagged field')",
                      "coalesce(issue_column, 'the flagged field')", "'this row'", "'unknown'")
    return (f"WITH {_cte('enc', ENC_SQL)}, issues AS (\n{ENC_UNION}\n)\n"
            f"SELECT {ENC_KEYS}, issue_type, {msg} AS drafted_query FROM issues")


@register("draft_messages_encounters", _enc_msg_sql())
def q_draft_messages_encounters(spark, sf_dir):
    from lintel.functions.messages import add_drafted_messages
    rules = packs.get_pack("clinical")["rules"]
    issues = RuleEngine(rules, review_date=ENC_REVIEW).issues(tables.clinical_encounters(spark, sf_dir))
    return add_drafted_messages(issues).select(*ENC_KEYS.split(", "), "issue_type", "drafted_query")
