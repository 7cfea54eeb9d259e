"""Configurable rules: semantics per type, edge values, dispatch and plan shape."""

import math

import pytest
from pyspark.sql import functions as F

from lintel import packs
from lintel.functions.columns import match_columns
from lintel.plans.engine import RuleEngine


def issues(df, rules, **opts):
    out = RuleEngine(rules, **opts).issues(df)
    return sorted((r["id"], r["issue_type"], r["rule_severity"],
                   None if r["metric_value"] is None else round(r["metric_value"], 4)) for r in out.collect())


@pytest.fixture(scope="module")
def t(spark):
    rows = [
        (1, "a", " ", 5.0, "2026-08-01", "2026-08-30", "M", "A12.3", "g", "g"),
        (2, None, "x", -1.0, "2026-09-01", "2026-08-01", "q", "U12", "g", "kg"),
        (3, "a", "\t", float("nan"), "bad", None, None, "A1", None, "kg"),
        (4, "b", "", 100.0, "2026/08/20", "2026-08-21", "female", None, "kg", "kg"),
    ]
    return spark.createDataFrame(rows, "id long, code_key string, note string, amount double, visit_date string, "
                                       "end_date string, gender string, icd string, unit string, expected_unit string")


def test_pattern_match_exact_then_search():
    cols = ["paid", "patient_id", "total", "Value"]
    assert match_columns("paid", cols) == ["paid"]
    assert match_columns(".*id$", cols) == ["paid", "patient_id"]
    assert match_columns(".*to.*", cols) == ["total"]
    assert match_columns("value", cols) == ["Value"]
    assert match_columns("([", cols) == []


def test_missing_value_blank_is_spaces_only(spark, t):
    got = issues(t, [{"id": "m", "type": "missing_value", "column": "note"}])
    # ' ' and '' are blank; a tab is not (trim strips spaces only).
    assert [g[0] for g in got] == [1, 4]
    assert got[0][3] == 50.0


def test_missing_value_thresholds(spark, t):
    r = {"id": "m", "type": "missing_value", "column": "code_key", "threshold_warning": 30}
    assert issues(t, [r]) == []  # 25 % < 30 -> column skipped
    r = {"id": "m", "type": "missing_value", "column": "code_key", "threshold_warning": 20, "threshold_critical": 25}
    assert issues(t, [r]) == [(2, "missing_code_key", "critical", 25.0)]


def test_duplicate_null_group_and_allow_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id long, k string")
    assert [g[0] for g in issues(df, [{"type": "duplicate", "column": "k"}])] == [1, 2, 3, 4]
    assert [g[0] for g in issues(df, [{"type": "duplicate", "column": "k", "allow_nulls": True}])] == [1, 2]
    assert issues(df, [{"type": "duplicate", "column": "k"}])[0][1:] == ("duplicate_k", "warning", 2.0)


def test_numeric_range_conditions(spark, t):
    r = {"id": "n", "type": "numeric_range", "column": "amount", "allow_negative": False, "max_value": 100}
    # -1 < 0 flags; 100 is not > 100; NaN > 100 is true in Spark (NaN is the largest double).
    got = issues(t, [r])
    assert [g[0] for g in got] == [2, 3]
    assert math.isnan([g for g in got if g[0] == 3][0][3])


def test_numeric_range_on_text_column_is_safe(spark, t):
    r = {"type": "numeric_range", "column": "note", "min_value": 0}
    assert issues(t, [r]) == []


def test_numeric_range_without_condition_is_skipped(spark, t):
    assert issues(t, [{"type": "numeric_range", "column": "amount"}]) == []


def test_outlier_fixed_bounds_and_iqr(spark):
    df = spark.range(0, 101).select(F.col("id"), F.col("id").cast("double").alias("value"))
    df = df.union(spark.createDataFrame([(1000, 1000.0)], "id long, value double"))
    fixed = issues(df, [{"type": "outlier", "column": "value", "lower_bound": 5, "upper_bound": 99}])
    assert [g[0] for g in fixed] == [0, 1, 2, 3, 4, 100, 1000]
    for mode in ("exact", "approx"):
        got = issues(df, [{"type": "outlier", "column": "value"}], quantiles=mode)
        assert [g[0] for g in got] == [1000], mode


def test_date_range_future_and_stale(spark, t):
    r = {"id": "d", "type": "date_range", "column": "visit_date", "check_future": True, "max_age_days": 10,
         "review_date": "2026-08-23"}
    got = issues(t, [r])
    # 2026-09-01 is future; 2026-08-01 is 22 days old; 'bad' and 'yyyy/MM/dd' do not parse as ISO dates.
    assert got == [(1, "stale_visit_date", "warning", 22.0), (2, "future_visit_date", "warning", None)]


def test_cardinality_counts_null_as_value(spark, t):
    r = {"type": "cardinality", "column": "code_key", "max_unique": 2}  # a, b, null -> 3
    assert [g[3] for g in issues(t, [r])] == [3.0] * 4
    assert issues(t, [{"type": "cardinality", "column": "code_key", "max_unique": 3}]) == []
    approx = issues(t, [r], distinct="approx")
    assert [g[3] for g in approx] == [3.0] * 4


def test_unit_mismatch(spark, t):
    got = issues(t, [{"type": "unit_mismatch"}])
    assert got == [(2, "unit_mismatch_unit", "warning", None)]


def test_allowed_values_case_insensitive(spark, t):
    got = issues(t, [{"type": "allowed_values", "column": "gender", "allowed_values": ["m", "F", "female"]}])
    assert [g[0] for g in got] == [2]
    assert issues(t, [{"type": "allowed_values", "column": "gender"}]) == []


def test_format_check(spark, t):
    regex = packs.get_pack("clinical")["rules"][10]["regex"]
    got = issues(t, [{"type": "format_check", "column": "icd", "regex": regex}])
    assert [g[0] for g in got] == [2, 3]


def test_date_order_and_same_column(spark, t):
    r = {"type": "date_order", "start_column": "visit_date", "end_column": "end_date"}
    assert issues(t, [r]) == [(2, "invalid_date_order_visit_date_end_date", "warning", None)]
    same = {"type": "date_order", "start_column": "visit_date", "end_column": "visit_date"}
    assert issues(t, [same]) == []


def test_dispatch_skips_disabled_and_unknown(spark, t):
    rules = [{"type": "numeric_range", "column": "amount", "min_value": 0, "enabled": False},
             {"type": "nope"}, {"type": "numeric_range", "column": "amount", "min_value": 0, "id": "x",
                                "severity": "critical"}]
    assert issues(t, rules) == [(2, "range_check_amount", "critical", -1.0)]


def test_reserved_input_columns_are_renamed(spark):
    df = spark.createDataFrame([(1, "high", None)], "id long, severity string, v double")
    out = RuleEngine([{"type": "missing_value", "column": "v"}]).issues(df)
    assert "input_severity" in out.columns and out.count() == 1


def test_row_local_rules_one_scan_no_exchange(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rules = [{"type": "numeric_range", "column": "l_quantity", "min_value": 2, "max_value": 40},
             {"type": "outlier", "column": "l_extendedprice", "lower_bound": 1000, "upper_bound": 9e4},
             {"type": "date_range", "column": "l_shipdate", "check_future": True, "max_age_days": 9000},
             {"type": "allowed_values", "column": "l_returnflag", "allowed_values": ["a", "n"]},
             {"type": "format_check", "column": "l_linestatus", "regex": "^[OF]$"}]
    plan = RuleEngine(rules).issues(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_packs_inventory():
    all_packs = packs.all_packs()
    assert [len(p["rules"]) for p in all_packs.values()] == [18, 6, 6, 6, 3]
    disabled = [r["id"] for p in all_packs.values() for r in p["rules"] if not r.get("enabled", True)]
    assert disabled == ["zero_quantity", "outliers"]
    from lintel.operators.rules import SUPPORTED_RULES
    assert all(r["type"] in SUPPORTED_RULES for p in all_packs.values() for r in p["rules"])
    with pytest.raises(KeyError):
        packs.get_pack("healthcare")
    assert packs.get_pack("healthcare", fallback=True)["domain"] == "generic"
    rules = packs.adapted("clinical", on=["invalid_age"], off=["invalid_age"], changes={"invalid_bmi": {"max_value": 60}})
    by_id = {r["id"]: r for r in rules}
    assert by_id["invalid_age"]["enabled"] is False and by_id["invalid_bmi"]["max_value"] == 60
    assert packs.get_pack("clinical")["rules"][13]["max_value"] == 80  # the stored pack is untouched


def test_long_allowed_list(spark):
    values = [f"v{i}" for i in range(5000)]
    df = spark.createDataFrame([(1, "V3"), (2, "zz"), (3, None)], "id long, status string")
    q = RuleEngine([{"type": "allowed_values", "column": "status", "allowed_values": values}]).issues(df)
    assert [r["id"] for r in q.collect()] == [2]


def test_iqr_over_two_columns_shares_one_job(spark):
    df = spark.range(0, 101).select("id", F.col("id").cast("double").alias("a_value"),
                                    (F.col("id") * -2).cast("double").alias("b_value"))
    df = df.union(spark.createDataFrame([(1000, 1000.0, 5.0), (1001, 50.0, -5000.0)], "id long, a_value double, b_value double"))
    for mode in ("exact", "approx"):
        got = issues(df, [{"type": "outlier", "column_pattern": "_value$"}], quantiles=mode)
        assert [(g[0], g[1]) for g in got] == [(1000, "outlier_a_value"), (1001, "outlier_b_value")], mode


def test_duplicate_window_strategy_matches_join(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id long, k string")
    rule = [{"type": "duplicate", "column": "k"}]
    assert issues(df, rule, duplicate_strategy="window") == issues(df, rule)


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5.0)], "`id` long, `key.with dot` string, `val ue` double")
    rules = [{"type": "duplicate", "column": "key.with dot"}, {"type": "missing_value", "column": "val ue"},
             {"type": "numeric_range", "column": "val ue", "min_value": 10}]
    got = issues(df, rules)
    assert [(g[0], g[1]) for g in got] == [(1, "duplicate_key.with dot"), (1, "missing_val ue"),
                                           (2, "duplicate_key.with dot"), (2, "range_check_val ue")]


def test_materialized_input_gives_same_issues(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5.0), (3, "b", 7.0)], "id long, k string, v double")
    rules = [{"type": "duplicate", "column": "k"}, {"type": "missing_value", "column": "v"},
             {"type": "outlier", "column": "v"}]
    assert issues(df, rules, materialize_input=True) == issues(df, rules)
