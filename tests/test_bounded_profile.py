"""Preview, profile without moving values, interval quartiles, kept sketches, type inference, rejected rows."""

import math
import re

import pytest
from pyspark.sql import functions as F

from lintel.operators import preview as V, profile as P, sketches as K
from lintel.operators.quantiles import exact_quantiles_grouped
from lintel.plans.engine import RuleEngine
from lintel.sources import inference, io


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- preview
def test_preview_depends_on_rows_alone(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("t"), F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("x"))
    rows = {tuple(r) for r in V.preview(df, 64).collect()}
    assert len(rows) == 64 and {r[-1] for r in rows} == {64 / 5000}
    for other in (df.repartition(13), df.orderBy(F.desc("id")).coalesce(1)):
        assert {tuple(r) for r in V.preview(other, 64).collect()} == rows
    halves = [V.bottom_k(df.where(F.col("id") % 2 == k), 64) for k in (0, 1)]
    merged = V.merge(halves, 64)
    assert {r["id"] for r in merged.collect()} == {r[0] for r in rows}
    guess = V.estimated_rows(V.bottom_k(df, 1000), 1000).first()["rows"]
    assert abs(guess - 5000) < 6 * 5000 / math.sqrt(998)
    assert "TakeOrderedAndProject" in plan(V.bottom_k(df, 64))


def test_preview_of_small_empty_and_repeated_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", [1]), (None, [])], "s string, v array<int>")
    assert V.preview(df, 10).count() == 4 and V.preview(df, 10).first()[V.FRACTION] == 1.0
    assert V.preview(df.limit(0), 10).count() == 0
    assert V.estimated_rows(V.bottom_k(df, 10), 10).first()["rows"] == 3
    with pytest.raises(ValueError):
        V.bottom_k(df.withColumn(V.KEY, F.lit(1)), 3)


def test_profile_of_a_preview(spark, tmp_path):
    spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("k")).write.parquet(str(tmp_path / "t"))
    part = {r["column"]: r for r in P.profile_path(spark, str(tmp_path / "t"), "parquet", preview_rows=100).collect()}
    assert part["id"]["unique_count"] == 100 and part["k"]["unique_count"] == 3
    spark.range(0).write.parquet(str(tmp_path / "e"))
    with pytest.raises(io.EmptyInputError):
        P.profile_path(spark, str(tmp_path / "e"), "parquet")


# ---------------------------------------------------------------- profile
def test_no_text_is_shuffled_for_distinct_counts(spark):
    df = spark.range(1000).select(F.concat(F.lit("long text "), F.col("id").cast("string")).alias("text"), F.col("id").cast("string").alias("key"))
    counted = P.distinct_by_hash(df, df.columns)
    carried = {f.dataType().simpleString() for f in _exchange_columns(counted)}
    assert carried <= {"int", "bigint", "double", "timestamp_ntz"}
    assert {r["position"]: r["unique_count"] for r in counted.collect()} == {0: 1000, 1: 1000}
    probed = plan(P.probes(df, df.columns))
    assert re.findall(r"Exchange (\w+)", probed) == ["SinglePartition"]      # one row per task


def _exchange_columns(df):
    node, out = df._jdf.queryExecution().sparkPlan(), []
    todo = [df._jdf.queryExecution().executedPlan()]
    del node
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.initialPlan())
            continue
        if p.nodeName() == "Exchange":
            out += [p.output().apply(i) for i in range(p.output().size())]
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_samples_and_counts_match_a_plain_fold(spark):
    rows = [(None if i % 11 == 0 else f"v{i % n:04}", float(i % 4), None, ["x"] * (i % 3)) for i in range(900) for n in (1, 6, 400)]
    df = spark.createDataFrame(rows, "a string, b double, c string, d array<string>")
    got = {r["column"]: r for r in P.profile(df).collect()}
    texts = sorted({r[0] for r in rows if r[0] is not None})
    assert got["a"]["sample_values"] == texts[:5] and got["a"]["unique_count"] == len(texts)
    assert got["a"]["null_count"] == sum(r[0] is None for r in rows)
    assert got["b"]["sample_values"] == ["0.0", "1.0", "2.0", "3.0"]
    assert (got["c"]["sample_values"], got["c"]["null_count"], got["c"]["inferred_type"]) == ([], len(rows), "unknown")
    assert got["d"]["unique_count"] == 3
    none = {r["column"]: r for r in P.profile(df.limit(0)).collect()}
    assert none["a"]["inferred_type"] == "unknown" and none["a"]["null_count"] == 0


# ---------------------------------------------------------------- quartiles
def test_quartiles_inside_a_narrow_interval(spark):
    special = F.when(F.col("id") % 1000 == 1, float("nan")).when(F.col("id") % 1000 == 2, float("inf")).when(F.col("id") % 1000 == 3, float("-inf"))
    df = spark.range(60000).select((F.col("id") % 3).alias("g"), special.when(F.col("id") % 3 == 0, 5.0).otherwise(F.sin("id") * F.exp(F.col("id") % 60 - 30)).alias("x"))
    want = {r["g"]: r for r in df.groupBy("g").agg(F.percentile("x", [0.0, 0.25, 0.5, 0.75, 1.0]).alias("p")).collect()}
    for row in exact_quantiles_grouped(df, "g", "x", [0.0, 0.25, 0.5, 0.75, 1.0]).collect():
        for i, w in enumerate(want[row["g"]]["p"]):
            assert row[f"q{i}"] == w or math.isnan(w) and math.isnan(row[f"q{i}"]) or abs(row[f"q{i}"] - w) <= 1e-12 * abs(w)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8])
def test_quartiles_of_few_values(spark, n):
    df = spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * F.col("id")).cast("double").alias("x"))
    row = exact_quantiles_grouped(df, "g", "x", [0.25, 0.75]).first()
    assert [row["q0"], row["q1"]] == df.agg(F.percentile("x", [0.25, 0.75])).first()[0]


def test_default_outlier_rule_reads_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, F.col("id") * 50.0).otherwise(F.col("id") % 90).cast("double").alias("value")).write.parquet(path)
    df = spark.read.parquet(path)
    found = RuleEngine([{"type": "outlier", "column": "value"}]).issues(df)
    q1, q3 = df.agg(F.percentile("value", [0.25, 0.75])).first()[0]
    assert found.count() == df.where((F.col("value") < q1 - 1.5 * (q3 - q1)) | (F.col("value") > q3 + 1.5 * (q3 - q1))).count() > 0
    # The sketch, the counts, and the rows that are checked; the counts are used twice and read once.
    q = exact_quantiles_grouped(df.select(F.lit(0).alias("g"), "value"), "g", "value", [0.25, 0.75])
    q.collect()
    final = q._jdf.queryExecution().executedPlan().toString()
    final = final[:final.index("== Initial Plan ==")]
    assert final.count("FileScan parquet") - final.count("ReusedExchange") <= 2 and "ReusedExchange" in final


# ---------------------------------------------------------------- sketches
def test_kept_sketches_follow_new_parts(spark, tmp_path):
    df = spark.range(30000).select((F.col("id") % 3).alias("day"), F.concat(F.lit("u"), (F.col("id") % 9000).cast("string")).alias("user"),
                                   F.when(F.col("id") % 10 > 0, F.col("id") % 50).alias("kind"))
    kept = str(tmp_path / "state")
    K.save(K.column_sketches(df.where("day < 2"), F.col("day"), ["user", "kind"]), kept)
    K.save(K.column_sketches(df.where("day = 2"), F.col("day"), ["user", "kind"]), kept)
    K.save(K.column_sketches(df.where("day = 2"), F.col("day"), ["user", "kind"]), kept)     # a rerun replaces its own part
    got = {r["column"]: r for r in K.estimates(K.load(spark, kept)).collect()}
    assert (got["user"]["non_null"], got["kind"]["null_count"]) == (30000, 3000)
    assert abs(got["user"]["unique_estimate"] - 9000) <= 5 * K.STANDARD_ERROR * 9000 and got["kind"]["unique_estimate"] == 45
    assert K.distinct_counts(K.load(spark, kept), ["kind", "absent"]).first().asDict() == {"d0": 46, "d1": 0}
    rules = [{"type": "cardinality", "column": "kind", "max_unique": 45}]
    assert RuleEngine(rules, distinct_state=K.load(spark, kept)).issues(df).count() == 30000
    assert K.estimates(K.column_sketches(df.limit(0), F.lit("p"))).count() == 0


# ---------------------------------------------------------------- types of text
def test_types_are_a_fold(spark, tmp_path):
    rows = [("1", "1", "true", "2024-01-05", "2024-01-05 10:20:30", "", "x"), ("-7", "1e3", "FALSE", " 2024-1-6 ", "2024-02-01", None, "1"), (None, ".5", " ", None, "2024-01-05T10:20", " ", "true")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    want = {"a": "bigint", "b": "double", "c": "boolean", "d": "date", "e": "timestamp", "f": "string", "g": "string"}
    for part in (df, df.repartition(3)):
        assert {r["column"]: r["inferred_type"] for r in inference.infer_types(part).collect()} == want
    kinds = dict(inference.typed(df).dtypes)
    assert (kinds["a"], kinds["e"], kinds["f"]) == ("bigint", "timestamp_ntz", "string")
    assert inference.typed(df).select("c").collect()[2][0] is None
    df.write.option("header", True).csv(str(tmp_path / "c.csv"))
    assert dict(io.read_table(spark, str(tmp_path / "c.csv"), infer=True).dtypes)["b"] == "double"
    assert inference.infer_types(df.limit(0)).select("inferred_type").distinct().collect()[0][0] == "string"
    with pytest.raises(io.EmptyInputError):
        df.limit(0).write.option("header", True).csv(str(tmp_path / "n.csv"))
        io.read_table(spark, str(tmp_path / "n.csv"), check_empty=True)


# ---------------------------------------------------------------- rejected rows
def test_ragged_lines_and_bad_values_are_kept_apart(spark, tmp_path):
    lines = ["data_received_date,record_id,value,source,patient_id,field_name,unit,expected_unit,ref_low,ref_high",
             "2026-08-01,R1,1.5,Lab,P1,f,u,u,1,2", "2026-13-01,R2,abc,Lab,P1,f,u,u,1,2", "2026-08-01,R3", "2026-08-01,R4,2,Lab,P1,f,u,u,1,2,extra",
             ",R5,,,,,,,,", "2026-08-02,R6,7,Lab,P1,f,u,u,low,2"]
    path = tmp_path / "r.csv"
    path.write_text("\n".join(lines) + "\n")
    split = io.split_csv(spark, str(path))
    assert {r["record_id"]: r["value"] for r in split.good().collect()} == {"R1": 1.5, "R5": None}
    bad = {r["line"] or r["raw"]: r["reject_reasons"] for r in split.bad().collect()}
    assert bad[lines[3]] == bad[lines[4]] == [io.MALFORMED]
    assert sorted(map(len, bad.values())) == [1, 1, 1, 2] and len(bad) == 4
    assert sum(r["rows"] for r in split.counts().collect()) == 2 + 2 + 2 + 1
    split.write(str(tmp_path / "out"))
    both = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["accepted"], r["count"]) for r in both.groupBy("accepted").count().collect()} == {("true", 2), ("false", 4)}


# ---------------------------------------------------------------- date formats
def test_formats_follow_all_values(spark):
    from lintel.operators.date_formats import date_formats, shapes
    rows = [("1/2/2024", "13.1.2024", "2024-05-06T10:20:30", "2024-13-01", "x", " ", "2024-01-02 " + "z" * 50)] * 3 + [
        ("25/2/2024", "1.2.2024", "2024-05-06T1:20", "2024-14-01", "2024-01-02", None, "2024-01-02")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    got = {r["column"]: (r["date_format"], r["field_order"], r["share"], r["values"]) for r in date_formats(df).collect()}
    assert got["a"] == ("d/M/yyyy", "known", 1.0, 4)          # the first value alone would have said M/d
    assert got["b"] == ("d.M.yyyy", "known", 1.0, 4)
    assert got["c"] == ("yyyy-M-d'T'H:mm", "known", 1.0, 4)
    assert got["d"] == ("yyyy-d-M", "known", 1.0, 4)
    assert got["e"] == (None, None, 0.25, 4) and got["g"] == (None, None, 0.25, 4) and "f" not in got
    assert {r["mask"]: r["values"] for r in shapes(df, ["a"]).collect()} == {"9/9/9999": 3, "99/9/9999": 1}
    assert date_formats(df.limit(0)).count() == 0 and date_formats(spark.range(3)).count() == 0
    carried = {f.name() for f in _exchange_columns(shapes(df))}
    assert "v" not in carried
