"""Registered queries: reviewer messages, reports, and a ten-rule engine run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lintel.functions.messages import add_drafted_messages
from lintel.functions.severity import score_rules
from lintel.operators import clinical, reports
from lintel.plans import tables
from lintel.plans.catalog import (CLINICAL_ORACLE_CTE, ISSUE_COLS, RD, RECORD_COLS, _issue_sql, _missing_sql,
                                  _scored, register, with_rec)
from lintel.plans.engine import RuleEngine


def message_sql(issue: str, field: str, subject: str, record: str, patient: str) -> str:
    """DuckDB form of the reviewer message (hand-written twin of ``functions.messages``)."""
    q = "''"
    return f"""CASE
  WHEN {issue} = 'missing_value' OR starts_with({issue}, 'missing_') THEN concat('Value for {q}', {field}, '{q} is empty on record ', {record}, ' (patient ', {patient}, '). Please supply it or confirm it was not collected.')
  WHEN contains({issue}, 'range') THEN concat('{q}', {subject}, '{q} on record ', {record}, ' (patient ', {patient}, ') lies outside its expected range. Please check the entry and correct it if needed.')
  WHEN starts_with({issue}, 'unit_mismatch') THEN concat('{q}', {subject}, '{q} on record ', {record}, ' (patient ', {patient}, ') was reported in an unexpected unit. Please confirm the unit and resend if needed.')
  WHEN {issue} = 'duplicate_measurement' OR starts_with({issue}, 'duplicate_') THEN concat('More than one row shares the same {q}', {field}, '{q}. Please say which row should be kept for review.')
  WHEN {issue} = 'stale_data' OR starts_with({issue}, 'stale_') THEN concat('Record ', {record}, ' is older than the freshness limit. Please check whether a newer value exists.')
  WHEN starts_with({issue}, 'future_') THEN concat('Record ', {record}, ' has a date in the future in {q}', {field}, '{q}. Please check the date.')
  WHEN starts_with({issue}, 'invalid_allowed_value_') THEN concat('Record ', {record}, ' holds a value in {q}', {field}, '{q} that is not on the allowed list. Please confirm the code.')
  WHEN starts_with({issue}, 'invalid_format_') THEN concat('Record ', {record}, ' has a badly formatted {q}', {field}, '{q}. Please check the identifier or code at the source.')
  WHEN starts_with({issue}, 'invalid_date_order_') THEN concat('Record ', {record}, ' ends before it starts. Please check the dates of the timeline.')
  WHEN starts_with({issue}, 'outlier_') THEN concat('Record ', {record}, ' differs widely from the rest in {q}', {field}, '{q}. Please compare it with where it came from.')
  ELSE concat('Record ', {record}, ' needs a look: {q}', {issue}, '{q} was found.')
END"""


CLIN_MSG = message_sql("issue_type", "coalesce(field_name, 'the flagged field')",
                       "coalesce(field_name, 'the flagged field')", "coalesce(record_id, 'this row')",
                       "coalesce(patient_id, 'unknown')")


@register("draft_messages", with_rec(f"SELECT record_id, issue_type, {CLIN_MSG} AS drafted_query FROM sev",
                                     CLINICAL_ORACLE_CTE))
def q_draft_messages(spark, sf_dir):
    return add_drafted_messages(_scored(spark, sf_dir)).select("record_id", "issue_type", "drafted_query")


@register("flagged_export", with_rec(
    f"SELECT {RECORD_COLS}, issue_type, severity, {CLIN_MSG} AS drafted_query FROM sev", CLINICAL_ORACLE_CTE))
def q_flagged_export(spark, sf_dir):
    from lintel.plans.review import export_projection
    return export_projection(add_drafted_messages(_scored(spark, sf_dir)), True)


@register("review_queue", with_rec(
    f"SELECT severity, issue_type, record_id, patient_id, source, field_name, {CLIN_MSG} AS drafted_query FROM sev",
    CLINICAL_ORACLE_CTE))
def q_review_queue(spark, sf_dir):
    return reports.review_queue(add_drafted_messages(_scored(spark, sf_dir)))


@register("flags_by_severity", with_rec("SELECT severity, COUNT(*) AS flagged_count FROM sev GROUP BY severity",
                                        CLINICAL_ORACLE_CTE))
def q_flags_by_severity(spark, sf_dir):
    return reports.flags_by(reports.summary_ranked(_scored(spark, sf_dir)), "severity")


@register("flags_by_source", with_rec("SELECT source, COUNT(*) AS flagged_count FROM sev GROUP BY source",
                                      CLINICAL_ORACLE_CTE))
def q_flags_by_source(spark, sf_dir):
    return reports.flags_by(reports.summary_ranked(_scored(spark, sf_dir)), "source")


@register("severity_kpis", with_rec(
    "SELECT COUNT(*) AS flagged, count_if(severity = 'high') AS high, count_if(severity = 'medium') AS medium FROM sev",
    CLINICAL_ORACLE_CTE))
def q_severity_kpis(spark, sf_dir):
    return reports.severity_kpis(reports.summary_ranked(_scored(spark, sf_dir)))


@register("review_kpis", with_rec(
    "SELECT COUNT(*) AS flagged_rows, count_if(lower(severity) = 'high') AS high_priority, "
    "COUNT(DISTINCT issue_type) AS issue_types, CAST(13 AS BIGINT) AS issue_columns FROM sev", CLINICAL_ORACLE_CTE))
def q_review_kpis(spark, sf_dir):
    from lintel.plans.review import export_projection
    return reports.review_kpis(export_projection(add_drafted_messages(_scored(spark, sf_dir)), True))


@register("severity_mix", with_rec(
    "SELECT lower(coalesce(severity, 'unknown')) AS severity, COUNT(*) AS rows FROM sev GROUP BY 1",
    CLINICAL_ORACLE_CTE))
def q_severity_mix(spark, sf_dir):
    return reports.severity_mix(_scored(spark, sf_dir))


@register("clinical_totals", with_rec(
    "SELECT (SELECT COUNT(*) FROM rec) AS total_records, COUNT(*) AS flagged_rows, "
    "(SELECT COUNT(*) FROM rec) - COUNT(*) AS clear_rows FROM flagged", CLINICAL_ORACLE_CTE))
def q_clinical_totals(spark, sf_dir):
    rec = tables.records(spark, sf_dir)
    return reports.clinical_totals(rec, clinical.run_checks_dataframe(rec, RD, tables.RECORDS_STALE_DAYS))


# ---- a ten-rule mix over the derived records (plus a disabled and an unknown rule)
MIX_RULES = [
    {"id": "mix_missing", "type": "missing_value", "column_pattern": "^(value|expected_unit)$", "severity": "high"},
    {"id": "mix_duplicate_patient", "type": "duplicate", "column": "patient_id", "severity": "low"},
    {"id": "mix_reference", "type": "numeric_range", "column": "value", "use_reference_range": True},
    {"id": "mix_dates", "type": "date_range", "column": "data_received_date", "check_future": True,
     "max_age_days": 14, "severity": "critical"},
    {"id": "mix_sources", "type": "cardinality", "column": "source", "max_unique": 2, "severity": "info"},
    {"id": "mix_units", "type": "unit_mismatch", "severity": "warning"},
    {"id": "mix_value_bounds", "type": "outlier", "column": "value", "lower_bound": 0, "upper_bound": 90},
    {"id": "mix_source_codes", "type": "allowed_values", "column": "source", "allowed_values": ["lab", "EDC"],
     "severity": "Medium"},
    {"id": "mix_record_format", "type": "format_check", "column": "record_id", "regex": "^E-[0-9]{1,3}$"},
    {"id": "mix_order", "type": "date_order", "start_column": "data_received_date", "end_column": "data_received_date"},
    {"id": "mix_disabled", "type": "numeric_range", "column": "value", "min_value": 0, "enabled": False},
    {"id": "mix_unknown", "type": "no_such_rule", "column": "value"},
]
KEYS = "record_id, patient_id, source, field_name"
DISTINCT_SOURCES = "(SELECT COUNT(DISTINCT source) + MAX(CASE WHEN source IS NULL THEN 1 ELSE 0 END) FROM rec)"
AGE = f"date_diff('day', data_received_date, DATE '{RD}')"

MIX_CTE = "issues AS (\n" + "\nUNION ALL ".join([
    _missing_sql(KEYS, "rec", "value", "mix_missing", "high"),
    _missing_sql(KEYS, "rec", "expected_unit", "mix_missing", "high"),
    _issue_sql(KEYS, "(SELECT *, COUNT(*) OVER (PARTITION BY patient_id) AS __n FROM rec) d", "__n > 1",
               "duplicate_patient_id", "patient_id", "mix_duplicate_patient", "'low'", "__n"),
    _issue_sql(KEYS, "rec", "ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high)",
               "range_check_value", "value", "mix_reference", "'warning'", "value"),
    _issue_sql(KEYS, "rec", f"data_received_date > DATE '{RD}'", "future_data_received_date", "data_received_date",
               "mix_dates", "'critical'"),
    _issue_sql(KEYS, "rec", f"{AGE} > 14", "stale_data_received_date", "data_received_date", "mix_dates",
               "'critical'", AGE),
    _issue_sql(KEYS, "rec", f"{DISTINCT_SOURCES} > 2", "high_cardinality_source", "source", "mix_sources", "'info'",
               DISTINCT_SOURCES),
    _issue_sql(KEYS, "rec", "unit IS NOT NULL AND expected_unit IS NOT NULL AND unit <> expected_unit",
               "unit_mismatch_unit", "unit", "mix_units", "'warning'"),
    _issue_sql(KEYS, "rec", "value < 0.0e0 OR value > 90.0e0", "outlier_value", "value", "mix_value_bounds",
               "'warning'", "value"),
    _issue_sql(KEYS, "rec", "source IS NOT NULL AND lower(source) NOT IN ('lab', 'edc')",
               "invalid_allowed_value_source", "source", "mix_source_codes", "'Medium'"),
    _issue_sql(KEYS, "rec", "record_id IS NOT NULL AND NOT regexp_matches(record_id, '^E-[0-9]{1,3}$')",
               "invalid_format_record_id", "record_id", "mix_record_format", "'warning'"),
]) + "\n)"


def mix_issues(spark, sf_dir) -> DataFrame:
    return RuleEngine(MIX_RULES, review_date=RD).issues(tables.records(spark, sf_dir))


@register("rule_engine_run", with_rec(f"SELECT {KEYS}, issue_type, issue_column, rule_id, rule_severity, "
                                      "metric_value FROM issues", MIX_CTE))
def q_rule_engine_run(spark, sf_dir):
    return mix_issues(spark, sf_dir).select("record_id", "patient_id", "source", "field_name", *ISSUE_COLS)


SEV_SQL = ("CASE WHEN lower(rule_severity) IN ('critical', 'high') THEN 'high' "
           "WHEN lower(rule_severity) IN ('info', 'low') THEN 'low' ELSE 'medium' END")


@register("severity_normalised", with_rec(
    f"SELECT record_id, rule_id, issue_type, rule_severity, {SEV_SQL} AS severity FROM issues", MIX_CTE))
def q_severity_normalised(spark, sf_dir):
    return score_rules(mix_issues(spark, sf_dir)).select("record_id", "rule_id", "issue_type", "rule_severity",
                                                         "severity")


RULE_MSG = message_sql("issue_type", "coalesce(issue_column, field_name, 'the flagged field')",
                       "coalesce(field_name, issue_column, 'the flagged field')", "coalesce(record_id, 'this row')",
                       "coalesce(patient_id, 'unknown')")


@register("draft_messages_rules", with_rec(
    f"SELECT record_id, rule_id, issue_type, {RULE_MSG} AS drafted_query FROM issues", MIX_CTE))
def q_draft_messages_rules(spark, sf_dir):
    scored = add_drafted_messages(score_rules(mix_issues(spark, sf_dir)))
    return scored.select("record_id", "rule_id", "issue_type", "drafted_query")


@register("summary_generic", with_rec(
    f"SELECT source, issue_type, {SEV_SQL} AS severity, COUNT(*) AS flagged_count FROM issues GROUP BY ALL", MIX_CTE))
def q_summary_generic(spark, sf_dir):
    return reports.summary_generic(score_rules(mix_issues(spark, sf_dir)))


@register("run_totals", with_rec(
    "SELECT (SELECT COUNT(*) FROM rec) AS total_records, (SELECT COUNT(*) FROM issues) AS issues, "
    "(SELECT COUNT(DISTINCT record_id) FROM issues) AS flagged_rows, "
    "(SELECT COUNT(*) FROM rec) - (SELECT COUNT(DISTINCT record_id) FROM issues) AS clear_rows", MIX_CTE))
def q_run_totals(spark, sf_dir):
    return reports.run_totals(RuleEngine(MIX_RULES, review_date=RD).annotate(tables.records(spark, sf_dir)))


# The ten rule types, written out so that the oracle does not follow the engine's list.
RULE_TYPES = ("missing_value", "duplicate", "numeric_range", "date_range", "cardinality", "unit_mismatch", "outlier",
              "allowed_values", "format_check", "date_order")


def rules_frame(spark, rules: list[dict]) -> DataFrame:
    rows = [(r.get("id", r.get("type")), r.get("type"), r.get("type") in RULE_TYPES, bool(r.get("enabled", True)))
            for r in rules]
    return spark.createDataFrame(rows, "id string, type string, implemented boolean, enabled boolean")


def rules_values_sql(rules: list[dict]) -> str:
    vals = ", ".join(
        f"('{r.get('id', r.get('type'))}', '{r.get('type')}', {str(r.get('type') in RULE_TYPES).upper()}, "
        f"{str(bool(r.get('enabled', True))).upper()})" for r in rules)
    return f"rules(id, type, implemented, enabled) AS (VALUES {vals})"


@register("rule_hit_coverage", with_rec(
    "SELECT r.id AS rule_id, r.type, r.implemented, r.enabled, CAST(coalesce(h.hits, 0) AS BIGINT) AS hits "
    "FROM rules r LEFT JOIN (SELECT rule_id, COUNT(*) AS hits FROM issues GROUP BY rule_id) h ON r.id = h.rule_id",
    MIX_CTE, rules_values_sql(MIX_RULES)))
def q_rule_hit_coverage(spark, sf_dir):
    return reports.rule_hit_coverage(rules_frame(spark, MIX_RULES), mix_issues(spark, sf_dir))


@register("rule_type_coverage", with_rec(
    "SELECT r.type, r.implemented, COUNT(*) AS rules, CAST(sum(coalesce(h.hits, 0)) AS BIGINT) AS hits "
    "FROM rules r LEFT JOIN (SELECT rule_id, COUNT(*) AS hits FROM issues GROUP BY rule_id) h ON r.id = h.rule_id GROUP BY ALL",
    MIX_CTE, rules_values_sql(MIX_RULES)))
def q_rule_type_coverage(spark, sf_dir):
    return reports.rule_type_coverage(q_rule_hit_coverage(spark, sf_dir))


CLASH_ENC = """src AS (SELECT event_id, event_type AS severity, props AS issue_type, value, user_id AS rule_id FROM events)"""


@register("clashing_input_names", f"""WITH {CLASH_ENC}
SELECT event_id, severity AS input_severity, issue_type AS input_issue_type, rule_id AS input_rule_id, 'outlier_value' AS issue_type, 'cap' AS rule_id,
       'high' AS severity, value AS metric_value FROM src WHERE value < 0 OR value > 90""")
def q_clashing_input_names(spark, sf_dir):
    """Input columns named like results keep their values under new names; results never show them."""
    ev = tables.table(spark, sf_dir, "events")
    src = ev.select("event_id", ev.event_type.alias("severity"), ev.props.alias("issue_type"), "value", ev.user_id.alias("rule_id"))
    rules = [{"id": "cap", "type": "outlier", "column": "value", "lower_bound": 0, "upper_bound": 90, "severity": "critical"}]
    found = score_rules(RuleEngine(rules, review_date=RD).issues(src))
    return found.select("event_id", "input_severity", "input_issue_type", "input_rule_id", "issue_type", "rule_id", "severity", "metric_value")


@register("cross_validate_differences", with_rec("""
SELECT record_id, issue_type, COUNT(*) AS surplus FROM (
  SELECT record_id, issue_type FROM (
    SELECT rec.*, COUNT(*) OVER (PARTITION BY patient_id, source, field_name) AS n FROM rec) r,
    LATERAL (SELECT unnest([CASE WHEN value IS NULL THEN 'missing_value' END, CASE WHEN unit <> expected_unit THEN 'unit_mismatch' END,
      CASE WHEN n > 1 THEN 'duplicate_measurement' END, CASE WHEN date_diff('day', data_received_date, DATE '%s') > %d THEN 'stale_data' END,
      CASE WHEN ref_low IS NOT NULL AND ref_high IS NOT NULL AND (value < ref_low OR value > ref_high) THEN 'out_of_range' END]) AS issue_type) x
  WHERE issue_type IS NOT NULL)
WHERE (record_id, issue_type) NOT IN (SELECT (record_id, issue_type) FROM flagged) GROUP BY ALL""" % (RD, tables.RECORDS_STALE_DAYS), CLINICAL_ORACLE_CTE))
def q_cross_validate_differences(spark, sf_dir):
    """Which issues the priority pick leaves out: all issues of every record against the picked ones, as multisets."""
    rec = tables.records(spark, sf_dir)
    return clinical.multiset_difference(clinical.run_checks_long(rec, RD, tables.RECORDS_STALE_DAYS), clinical.run_checks_dataframe(rec, RD, tables.RECORDS_STALE_DAYS))


@register("sources_ranked", """WITH c AS (SELECT user_id AS source, event_type AS severity, COUNT(*) AS flagged_count FROM events GROUP BY ALL)
SELECT source, severity, flagged_count, CAST(rank() OVER (PARTITION BY severity ORDER BY flagged_count DESC) AS INTEGER) AS rank_within_severity FROM c""")
def q_sources_ranked(spark, sf_dir):
    """The ranked summary over many sources: users as sources, event types as severities."""
    events = tables.table(spark, sf_dir, "events")
    return reports.summary_ranked(events.select(events.user_id.alias("source"), events.event_type.alias("severity")))
