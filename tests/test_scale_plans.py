"""Plans that must hold at scale: linear duplicate counts and a salt that reaches the exchange."""

import re

from pyspark.sql import functions as F

from lintel.operators.groups import attach_group_count
from lintel.operators.reports import run_totals
from lintel.operators.stats import distinct_counts
from lintel.plans.engine import RuleEngine


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Range (")


def test_duplicate_rules_add_up(spark):
    df = spark.range(100).select(*[(F.col("id") % k).alias(f"c{k}") for k in (2, 3, 5, 7)])
    sizes = [scans(RuleEngine([{"id": f"d{i}", "type": "duplicate", "column": c} for i, c in enumerate(df.columns[:n])]).issues(df)) for n in (1, 2, 3, 4)]
    steps = {b - a for a, b in zip(sizes, sizes[1:], strict=False)}
    assert len(steps) == 1 and sizes[-1] <= 4 * sizes[0]


def test_hot_rows_spread_over_partitions(spark):
    for make in (lambda i: i, lambda i: F.concat(F.lit("row"), i.cast("string"))):
        df = spark.range(60000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 9000).cast("string"))).alias("k"), make(F.col("id")).alias("v"))
        out = attach_group_count(df, ["k"], "n", hot_fraction=0.1)
        assert out.where("k = 'hot'").select("n").distinct().collect()[0][0] == 20000
        assert out.where("n is null").count() == 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            parted = attach_group_count(df, ["k"], "n", hot_fraction=0.1)
            plan = parted._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"hashpartitioning\([^)]*__lns", plan)
            per = parted.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
            assert len(per) >= 6 and max(r["count"] for r in per) < 10000
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_nested_values_stay_distinct(spark):
    df = spark.createDataFrame([(["a, b"],), (["a", "b"],), (["a", "b"],)], "v array<string>")
    assert distinct_counts(df, ["v"]).first()["d0"] == 2


def test_totals_of_an_empty_table_are_zero(spark):
    row = run_totals(spark.createDataFrame([], "issues array<int>")).first()
    assert (row["total_records"], row["issues"], row["flagged_rows"], row["clear_rows"]) == (0, 0, 0, 0)


def test_exact_quartiles_do_not_depend_on_exchange_reuse(spark):
    from lintel.operators.quantiles import exact_quantiles_grouped
    x = F.when(F.col("id") % 3 == 0, 7.25).when(F.col("id") % 50 == 0, None).otherwise(F.sin("id") * F.exp(F.col("id") % 40) - 5)
    df = spark.range(20000).select((F.col("id") % 3 * F.col("id") % 2).alias("g"), x.alias("x"))
    want = {r["g"]: (r["a"], r["b"], r["c"]) for r in df.groupBy("g").agg(*[F.percentile("x", p).alias(n) for p, n in ((0.25, "a"), (0.5, "b"), (0.75, "c"))]).collect()}
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        got = {r["g"]: (r["q0"], r["q1"], r["q2"]) for r in exact_quantiles_grouped(df, "g", "x", [0.25, 0.5, 0.75]).collect()}
        assert got.keys() == want.keys() and all(abs(a - b) <= 1e-9 * max(1, abs(b)) for g in want for a, b in zip(got[g], want[g], strict=True))
    spark.conf.unset("spark.sql.exchange.reuse")


def test_domain_reads_every_column_and_weighs_by_share(spark):
    from lintel.operators.domain import best_domain
    share = lambda n: spark.range(300).select(*[F.lit("zz").alias(f"a{i}") for i in range(30)],
                                              F.when(F.col("id") < n, "WAREHOUSE, stock").otherwise("aa").alias("a30"))
    best = best_domain(share(60))
    assert best["domain"] == "inventory" and best["reason"] == ["stock", "warehouse"]
    assert best_domain(share(59))["domain"] == "generic"         # fewer than one value of five
    prose = spark.range(50).select(F.concat_ws(" ", F.lit("the lab gave a result for the patient"), F.lit(" and so on" * 30)).alias("a"))
    assert best_domain(prose)["domain"] == "generic"             # few of many words
    part = spark.range(5).select(F.lit("labor stocks multiunit").alias("a"))
    assert best_domain(part)["domain"] == "generic"              # no whole word
    assert best_domain(spark.range(3).select(F.lit("Heart-Rate").alias("a")))["reason"] == ["heart_rate"]


def test_duplicate_counts_run_once_a_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(30000).select("id", (F.col("id") % 7000).alias("k"), (F.col("id") % 9000).cast("string").alias("s")).write.parquet(path)
    df = spark.read.parquet(path)
    for n in (1, 2):
        found = RuleEngine([{"id": c, "type": "duplicate", "column": c} for c in ("k", "s")[:n]]).issues(df)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        # The rows once and the counts of each key once; hot keys, cold keys and the total read the same exchange.
        assert final.count("FileScan parquet") <= 1 + n, final
