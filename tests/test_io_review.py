"""Ingest by name, safe casts, conformance, the review run and its exports."""

import json
import os

import pytest

from conftest import FIXTURES
from lintel.plans.review import Review
from lintel.sources import io


def write_csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_reordered_header_reads_by_name(spark, tmp_path):
    src = open(os.path.join(FIXTURES, "clinical_records.csv")).read().splitlines()
    header = src[0].split(",")
    order = list(reversed(range(len(header))))
    lines = [",".join(line.split(",")[i] for i in order) for line in src]
    path = write_csv(tmp_path, "rev.csv", "\n".join(lines) + "\n")
    got = io.read_records(spark, path, "csv").where("record_id = 'N05'").first()
    assert got["value"] == 6.5 and got["ref_low"] == 3.5 and str(got["data_received_date"]) == "2026-08-19"


def test_bad_values_become_null_and_are_counted(spark, tmp_path):
    text = ("record_id,patient_id,source,field_name,value,unit,expected_unit,ref_low,ref_high,data_received_date\n"
            "A,P,Lab,F,abc,u,u,1,2,x\nB,P,Lab,F,3,u,u,1,2,2026-01-02\nC,P,Lab,F,,u,u,1,2,\n")
    path = write_csv(tmp_path, "bad.csv", text)
    df = io.read_records(spark, path, "csv")
    assert df.where("record_id = 'A'").first()["value"] is None
    raw = spark.read.option("header", True).csv(path)
    conf = {r["column"]: r for r in io.schema_conformance(raw).collect()}
    assert (conf["value"]["non_null"], conf["value"]["cast_failures"]) == (2, 1)
    assert conf["data_received_date"]["cast_failures"] == 1


def test_missing_column_strict(spark):
    df = spark.createDataFrame([("a",)], "record_id string")
    with pytest.raises(ValueError):
        io.conform(df)
    assert io.conform(df, strict=False).columns[-1] == "data_received_date"


def test_empty_input_raises(spark):
    with pytest.raises(io.EmptyInputError):
        io.ensure_not_empty(spark.range(0))


def test_clinical_review_run(spark, sample_records, tmp_path):
    meta = Review(sample_records).write(str(tmp_path / "out"))
    assert (meta["total_records"], meta["flagged_records"], meta["clear_records"]) == (21, 14, 7)
    back = io.read_back(spark, str(tmp_path / "out" / "flagged_records"), "csv")
    assert back.count() == 14 and back.columns[-1] == "drafted_query"
    assert io.read_back(spark, str(tmp_path / "out" / "summary_report"), "csv").count() == 5
    saved = io.read_back(spark, str(tmp_path / "out" / "run_metadata"), "json").first()
    assert saved["flagged_records"] == 14 and saved["clinical_sql_validated"] is True


def test_forced_clinical_mode_needs_columns(spark):
    with pytest.raises(ValueError):
        Review(spark.createDataFrame([(1,)], "x long"), mode="clinical")


def test_configurable_review_with_no_flags_still_writes_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0)], "id long, amount double")
    review = Review(df, rules=[{"type": "numeric_range", "column": "amount", "min_value": 0}])
    meta = review.write(str(tmp_path / "o2"))
    assert (meta["issues"], meta["flagged_records"], meta["clear_records"]) == (0, 0, 1)
    back = io.read_back(spark, str(tmp_path / "o2" / "flagged_records"))
    assert "issue_type" in back.columns and back.count() == 0
    header = spark.read.option("header", True).csv(io.published(spark, str(tmp_path / "o2"))["flagged_records"][0])
    assert "issue_type" in header.columns and header.count() == 0
    res = io.read_back(spark, str(tmp_path / "o2" / "rule_resolution")).collect()
    assert [(r["column"], r["status"]) for r in res] == [("amount", "checked")]


def test_configurable_totals_count_rows_not_issues(spark):
    df = spark.createDataFrame([(1, -5.0, None), (2, 5.0, "x")], "id long, amount double, note string")
    rules = [{"type": "numeric_range", "column": "amount", "min_value": 0},
             {"type": "missing_value", "column": "note"}]
    row = Review(df, rules=rules).totals().first()
    assert (row["issues"], row["flagged_rows"], row["clear_rows"]) == (2, 1, 1)


def test_auto_mode_picks_pack_from_domain(spark):
    df = spark.createDataFrame([("T1", 10.0), ("T1", -3.0)], "transaction_id string, amount double")
    review = Review(df)
    assert review.pack_id == "financial"
    types = {r["issue_type"] for r in review.flagged().collect()}
    assert {"duplicate_transaction_id", "range_check_amount"} <= types


def test_metadata_json(spark, sample_records):
    meta = Review(sample_records).metadata().first()
    assert json.loads(json.dumps(meta.asDict()))["clear_records"] == 7


def test_configurable_metadata_and_write_agree(spark, tmp_path):
    df = spark.createDataFrame([(1, -5.0, None), (2, 5.0, "x"), (3, -1.0, "y")], "id long, amount double, note string")
    rules = [{"type": "numeric_range", "column": "amount", "min_value": 0},
             {"type": "missing_value", "column": "note"}]
    review = Review(df, rules=rules)
    lazy = review.metadata().first()
    meta = review.write(str(tmp_path / "o3"))
    assert (lazy["issues"], lazy["flagged_records"], lazy["clear_records"]) == (3, 2, 1)
    assert (meta["issues"], meta["flagged_records"], meta["clear_records"]) == (3, 2, 1)


def test_list_packs_and_profile_path(spark, tmp_path):
    from lintel import packs
    from lintel.operators.profile import profile_path
    assert packs.rule_counts() == {"clinical": 18, "financial": 6, "inventory": 6, "web_analytics": 6, "generic": 3}
    prof = profile_path(spark, os.path.join(FIXTURES, "clinical_records.csv"), "csv")
    assert prof.where("column = 'record_id'").first()["unique_count"] == 21


def test_json_read_back_and_queue(spark, sample_records, tmp_path):
    review = Review(sample_records)
    io.write_table(review.summary(), str(tmp_path / "s"), "json")
    assert io.read_back(spark, str(tmp_path / "s"), "json").count() == 5
    top = review.queue(top=3).collect()
    assert len(top) == 3 and all(r["severity"] == "high" for r in top)


def test_auto_mode_classification(spark):
    df = spark.createDataFrame([("T1", 10.0), ("T2", -3.0)], "transaction_id string, amount double")
    assert Review(df).pack_id == "financial"


def test_a_lost_driver_leaves_one_valid_version(spark, tmp_path, monkeypatch):
    text = 'line one\nline "two", back\\slash\\'
    rows = [(1, -5.0, text), (2, 5.0, ""), (3, -1.0, None), (4, -2.0, "d")]
    df = spark.createDataFrame(rows, "id long, amount double, note string")
    rules = [{"type": "numeric_range", "column": "amount", "min_value": 0}, {"type": "missing_value", "column": "note"}]
    out = str(tmp_path / "out")
    first = Review(df, rules=rules, input_path="somewhere").write(out)
    assert (first["issues"], first["flagged_records"], first["clear_records"], first["input_path"]) == (5, 4, 0, "somewhere")
    back = {(r["id"], r["issue_type"]): r for r in io.read_back(spark, f"{out}/flagged_records").collect()}
    assert len(back) == 5 and back[1, "range_check_amount"]["note"] == text and back[2, "missing_note"]["note"] is None  # CSV has one blank
    for step in ("rule_resolution", "run_metadata", "publish"):
        def lost(self, *a, _step=step, _add=io.Version.add, _publish=io.Version.publish):
            if _step in ("publish", a[0]):
                raise RuntimeError("driver lost")
            return _add(self, *a)
        with monkeypatch.context() as m:
            m.setattr(io.Version, "publish" if step == "publish" else "add", lost)
            with pytest.raises(RuntimeError):
                Review(df.limit(1), rules=rules).write(out)
        assert io.read_back(spark, f"{out}/run_metadata").first()["run_id"] == first["run_id"]
        assert io.read_back(spark, f"{out}/flagged_records").count() == 5
    second = Review(df.where("id > 2"), rules=rules).write(out, fmt="parquet")
    assert io.read_back(spark, f"{out}/run_metadata").first()["run_id"] == second["run_id"]
    assert io.read_back(spark, f"{out}/flagged_records").count() == second["issues"] == 3
    assert not os.path.exists(f"{out}/_flagged_rows")


def test_review_of_a_stored_table(spark, tmp_path):
    from lintel.plans.review import review_path
    path = str(tmp_path / "t.parquet")
    spark.range(500).selectExpr("concat('T', id) AS transaction_id", "cast(id AS double) AS amount").write.parquet(path)
    review = review_path(spark, path, preview_rows=20)
    assert review.pack_id == "financial" and review.input_path == path
    assert review.preview(7).count() == 7
    spark.range(0).write.parquet(str(tmp_path / "e.parquet"))
    with pytest.raises(io.EmptyInputError):
        review_path(spark, str(tmp_path / "e.parquet"))


def test_unequal_multiplicities_are_differences(spark):
    from lintel.operators import clinical
    a = spark.createDataFrame([("R1", "x"), ("R1", "x"), ("R2", "y"), (None, "z"), (None, "z")], "record_id string, issue_type string")
    b = spark.createDataFrame([("R1", "x"), ("R2", "y"), ("R3", "y"), (None, "z"), (None, "z")], "record_id string, issue_type string")
    assert clinical.cross_validate_frame(a, b).first().asDict() == {"only_dataframe": 1, "only_sql": 1, "in_both": 4}
    assert {tuple(r) for r in clinical.multiset_difference(a, b).collect()} == {("R1", "x", 1), ("R3", "y", -1)}
    assert clinical.cross_validate(a, a) and clinical.cross_validate_frame(a.limit(0), a.limit(0)).first()["in_both"] == 0
    with pytest.raises(AssertionError, match="R1"):
        clinical.cross_validate(a, b)


def test_ranks_without_a_window_over_rows(spark):
    from pyspark.sql import functions as F
    from lintel.operators.reports import ranked_within, summary_ranked
    df = spark.range(100000).select(F.concat(F.lit("s"), F.col("id") % 40000).alias("source"), F.when(F.col("id") % 3 > 0, "high").alias("severity"))
    counts = df.groupBy("source", "severity").agg(F.count(F.lit(1)).alias("n"))
    got = ranked_within(counts, "severity", "n", "r")
    want = counts.selectExpr("*", "rank() OVER (PARTITION BY severity ORDER BY n DESC) AS r")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    plan = summary_ranked(df)._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert "source" not in window[:window.index("\n")] and summary_ranked(df.limit(0)).count() == 0
