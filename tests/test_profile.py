"""Profiler, domain classification and recommendations."""

from pyspark.sql import functions as F

from lintel.operators import domain as D, profile as P, recommend as R


def small_frame(spark):
    return spark.createDataFrame(
        [("P1", "2026-08-01", 90.0, "Mumbai"), ("P2", "2026-08-02", 180.0, "Delhi"), ("P3", "2026-08-03", None, "Mumbai")],
        "patient_id string, visit_date string, glucose_value double, site string")


def test_roles_types_and_domain(spark):
    df = small_frame(spark)
    prof = {r["column"]: r for r in P.profile(df).collect()}
    assert prof["patient_id"]["semantic_role"] == "id"
    assert prof["visit_date"]["inferred_type"] == "date"
    assert prof["visit_date"]["confidence"] == 0.95
    assert prof["glucose_value"]["semantic_role"] == "measurement"
    assert prof["glucose_value"]["null_count"] == 1 and abs(prof["glucose_value"]["null_ratio"] - 1 / 3) < 1e-9
    assert prof["site"]["unique_count"] == 2
    assert prof["site"]["sample_values"] == ["Delhi", "Mumbai"]
    best = D.best_domain_frame(D.domain_scores(df)).first()
    assert best["domain"] == "clinical" and best["confidence"] > 0


def test_number_and_date_probes(spark):
    df = spark.createDataFrame([("12d", "2026/8/1"), ("1e5", "8/1/2026"), (" 12 ", "2026-08-01"), ("NaN", "x")],
                               "n string, d string")
    prof = {r["column"]: r for r in P.profile(df).collect()}
    assert prof["n"]["inferred_type"] != "numeric"  # only 2 of 4 are plain numbers
    assert prof["d"]["inferred_type"] == "date"     # 3 of 4 shaped and parsed


def test_empty_column_is_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b string")
    prof = {r["column"]: r for r in P.profile(df).collect()}
    assert (prof["b"]["inferred_type"], prof["b"]["confidence"]) == ("unknown", 0.5)


def test_generic_when_nothing_matches(spark):
    df = spark.createDataFrame([("zz", 1)], "qq string, ww long")
    best = D.best_domain_frame(D.domain_scores(df)).first()
    assert (best["domain"], best["confidence"], best["reason"]) == ("generic", 0.25, [])


def test_tie_goes_to_first_domain(spark):
    df = spark.createDataFrame([(1, 2)], "lab long, sku long")  # clinical 2, inventory 2
    assert D.best_domain_frame(D.domain_scores(df)).first()["domain"] == "clinical"


def test_recommendations(spark):
    df = small_frame(spark)
    rec = {(r["column"], r["type"]): r for r in R.recommend_rules(df).collect()}
    assert rec[("glucose_value", "missing_value")]["threshold_warning"] == 43
    assert rec[("glucose_value", "missing_value")]["threshold_critical"] == 58
    assert rec[("patient_id", "duplicate")]["allow_nulls"] is False
    assert rec[("visit_date", "date_range")]["max_age_days"] == 365
    o = rec[("glucose_value", "outlier")]
    assert (o["lower_bound"], o["upper_bound"]) == (45.0, 225.0)  # q1 112.5, q3 157.5
    rules = R.rules_from_frame(R.recommend_rules(df))
    assert {r["type"] for r in rules} >= {"missing_value", "duplicate", "date_range", "outlier"}


def test_profile_summary_and_table(spark):
    prof = P.profile(small_frame(spark))
    summ = {(r["metric"], r["key"]): r["value"] for r in P.profile_summary(prof).collect()}
    assert summ[("total_columns", None)] == 4 and summ[("columns_with_nulls", None)] == 1
    tab = {r["column"]: r for r in P.profile_table(prof).collect()}
    assert tab["glucose_value"]["null_pct"] == 33.33
    assert P.profile_type_counts(prof).agg(F.sum("columns")).first()[0] == 4
