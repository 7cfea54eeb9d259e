"""Fixed clinical check: goldens, DataFrame/SQL agreement, severity, summary, quirks."""

import pytest
from pyspark.sql import functions as F

from conftest import record_rows
from lintel.functions.severity import score_clinical
from lintel.operators import clinical, reports

GOLDEN = {  # record -> (issue, pct_outside or None, severity); review 2026-08-23, 14 days, 0.4
    "N02": ("out_of_range", 0.125, "medium"), "N03": ("missing_value", None, "high"),
    "N05": ("out_of_range", 1.0, "high"), "N06": ("missing_value", None, "high"),
    "N07": ("out_of_range", 0.25, "medium"), "N09": ("out_of_range", 0.5, "high"),
    "N11": ("unit_mismatch", None, "high"), "N12": ("stale_data", None, "high"),
    "N13": ("duplicate_measurement", None, "medium"), "N14": ("duplicate_measurement", None, "medium"),
    "N15": ("missing_value", None, "high"), "N16": ("missing_value", None, "high"),
    "N17": ("out_of_range", 1.2, "high"), "N18": ("out_of_range", 2.0, "high"),
}


def test_sample_golden(spark, sample_records):
    scored = score_clinical(clinical.run_checks_dataframe(sample_records))
    got = {r["record_id"]: (r["issue_type"], round(r["pct_outside"], 4), r["severity"]) for r in scored.collect()}
    assert set(got) == set(GOLDEN)
    for rid, (issue, pct, sev) in GOLDEN.items():
        assert got[rid][0] == issue and got[rid][2] == sev, rid
        if pct is not None:
            assert got[rid][1] == pytest.approx(pct, abs=1e-4), rid
    assert sample_records.count() - len(got) == 7


def test_sample_sql_twin_agrees(spark, sample_records):
    df = clinical.run_checks_dataframe(sample_records)
    sql = clinical.run_checks_sql(spark, sample_records)
    assert clinical.cross_validate(df, sql)
    row = clinical.cross_validate_frame(df, sql).first()
    assert (row["only_dataframe"], row["only_sql"], row["in_both"]) == (0, 0, 14)


def test_sample_summary_ranks(spark, sample_records):
    scored = score_clinical(clinical.run_checks_dataframe(sample_records))
    got = {(r["severity"], r["source"]): (r["flagged_count"], r["rank_within_severity"]) for r in reports.summary_ranked(scored).collect()}
    assert got == {("high", "Clinic"): (5, 1), ("high", "Ward"): (4, 2), ("high", "Pharmacy"): (1, 3),
                   ("medium", "Ward"): (3, 1), ("medium", "Clinic"): (1, 2)}


# One row per issue type and two of a repeated key; made up for this test.
HAND_ROWS = [
    ("fine", "bo", "Ward", "Pulse", 61.0, "bpm", "bpm", 50.0, 100.0, "2026-08-20"),
    ("none", "cy", "Ward", "Pulse", None, "bpm", "bpm", 50.0, 100.0, "2026-08-20"),
    ("far", "di", "Ward", "Pulse", 25.0, "bpm", "bpm", 50.0, 100.0, "2026-08-20"),
    ("near", "ed", "Ward", "Pulse", 45.0, "bpm", "bpm", 50.0, 100.0, "2026-08-20"),
    ("unit", "flo", "Clinic", "Weight", 150.0, "lb", "kg", 40.0, 120.0, "2026-08-20"),
    ("old", "gus", "Clinic", "Weight", 80.0, "kg", "kg", 40.0, 120.0, "2026-07-30"),
    ("twin1", "hal", "Clinic", "Weight", 71.0, "kg", "kg", 40.0, 120.0, "2026-08-20"),
    ("twin2", "hal", "Clinic", "Weight", 72.0, "kg", "kg", 40.0, 120.0, "2026-08-21"),
]
HAND_SEVERITY = {"none": "high", "far": "high", "near": "medium", "unit": "high", "old": "high", "twin1": "medium", "twin2": "medium"}


def test_hand_rows(spark):
    df = record_rows(spark, HAND_ROWS)
    flagged = clinical.run_checks_dataframe(df)
    assert {r["record_id"]: r["severity"] for r in score_clinical(flagged).collect()} == HAND_SEVERITY
    assert clinical.cross_validate(flagged, clinical.run_checks_sql(spark, df))


def test_input_columns_never_decide_severity(spark):
    from lintel.plans.review import Review
    df = record_rows(spark, HAND_ROWS).withColumns({"severity": F.lit("bogus"), "rule_severity": F.lit("info"), "duplicate_count": F.lit(9)})
    rows = Review(df).issues().collect()
    assert {r["record_id"]: r["severity"] for r in rows} == HAND_SEVERITY
    assert all((r["input_severity"], r["input_rule_severity"], r["duplicate_count"]) == ("bogus", "info", 9) for r in rows)
    assert clinical.cross_validate(clinical.run_checks_dataframe(df), clinical.run_checks_sql(spark, df))


def test_null_upper_bound_not_flagged_in_either_form(spark):
    # K1: ref_high null, value below ref_low -> not out of range in both forms.
    df = record_rows(spark, [("K-1", "P-1", "Lab", "Glucose", 10.0, "mg/dL", "mg/dL", 70.0, None, "2026-08-22")])
    assert clinical.run_checks_dataframe(df).count() == 0
    assert clinical.run_checks_sql(spark, df).count() == 0


def test_boundaries_are_strict(spark):
    rows = [("B-1", "P-1", "Lab", "A", 70.0, "u", "u", 70.0, 110.0, "2026-08-09"),   # 14 days old, = low
            ("B-2", "P-2", "Lab", "A", 110.0, "u", "u", 70.0, 110.0, "2026-08-23")]  # = high, review day
    assert clinical.run_checks_dataframe(record_rows(spark, rows)).count() == 0


def test_long_form_first_issue_is_priority_pick(spark, sample_records):
    long = clinical.run_checks_long(sample_records)
    order = {n: i for i, n in enumerate(clinical.ISSUE_ORDER)}
    first = (long.withColumn("o", F.udf(lambda s: order[s], "int")("issue_type"))
             .groupBy("record_id").agg(F.min("o").alias("o")).collect())
    picked = {r["record_id"]: r["issue_type"] for r in clinical.run_checks_dataframe(sample_records).collect()}
    assert {r["record_id"]: clinical.ISSUE_ORDER[r["o"]] for r in first} == picked


def test_hot_key_path_matches_window(spark):
    """Force every key to be 'hot' (broadcast path) and none (shuffle path): same counts."""
    from pyspark.sql import Window
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 11 == 0, F.lit(None))
         .otherwise((F.col("id") % 97).cast("string")).alias("k"), "id")
    expect = {r["id"]: r["n"] for r in df.withColumn("n", F.count("*").over(Window.partitionBy("k"))).collect()}
    from lintel.operators.groups import attach_group_count
    for kw in ({"hot_fraction": 0.2}, {"hot_fraction": 1.0}, {}):
        got = {r["id"]: r["n"] for r in attach_group_count(df, ["k"], "n", **kw).collect()}
        assert {i: (n if n and n > 1 else None) for i, n in expect.items()} == got
