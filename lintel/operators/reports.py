"""Summaries, totals and KPIs over issue tables (all distributed aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def ranked_within(counts: DataFrame, within: str, count: str, out: str) -> DataFrame:
    """``rank`` of each row inside its ``within`` group by falling ``count``, without a window over the rows.

    A histogram says how many rows have each count; a running sum over its different
    counts (at most about the square root of twice what was counted) gives each
    count's rank, which is joined back.
    """
    hist = counts.groupBy(F.col(within).alias("__w"), F.col(count).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    above = Window.partitionBy("__w").orderBy(F.col("__c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select("__w", "__c", (F.coalesce(F.sum("__n").over(above), F.lit(0)) + 1).cast("int").alias(out))
    return counts.join(ranks, F.col(within).eqNullSafe(F.col("__w")) & F.col(count).eqNullSafe(F.col("__c"))).drop("__w", "__c")


def summary_ranked(flagged: DataFrame) -> DataFrame:
    """Count by (source, severity); rank sources inside each severity by count."""
    counts = flagged.groupBy("source", "severity").agg(F.count(F.lit(1)).alias("flagged_count"))
    return ranked_within(counts, "severity", "flagged_count", "rank_within_severity").orderBy("severity", F.col("flagged_count").desc())


def summary_generic(flagged: DataFrame) -> DataFrame:
    """Count by (source, else issue_column), issue_type, severity."""
    source = F.col("source") if "source" in flagged.columns else F.col("issue_column")
    return (flagged.groupBy(source.alias("source"), "issue_type", "severity")
            .agg(F.count(F.lit(1)).alias("flagged_count")))


def run_totals(annotated: DataFrame, issues_col: str = "issues") -> DataFrame:
    """Rows, issues, flagged rows and clear rows from rows carrying an issue array."""
    n = F.size(F.col(issues_col))
    return annotated.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("issues"),
        F.count_if(n > 0).alias("flagged_rows"),
        F.count_if(n == 0).alias("clear_rows"),
    )


def clinical_totals(records: DataFrame, flagged: DataFrame) -> DataFrame:
    """Totals for the clinical path (one issue per flagged row)."""
    total = records.agg(F.count(F.lit(1)).alias("total_records"))
    fl = flagged.agg(F.count(F.lit(1)).alias("flagged_rows"))
    t, f = total.scalar(), fl.scalar()
    return total.sparkSession.range(1).select(
        t.alias("total_records"), f.alias("flagged_rows"), F.greatest(t - f, F.lit(0)).alias("clear_rows"))


def flags_by(summary: DataFrame, key: str) -> DataFrame:
    """Sum of flagged_count by ``key`` (severity or source)."""
    return (summary.groupBy(key).agg(F.sum("flagged_count").cast("long").alias("flagged_count"))
            .orderBy(F.col("flagged_count").desc()))


def severity_kpis(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.coalesce(F.sum("flagged_count"), F.lit(0)).cast("long").alias("flagged"),
        F.coalesce(F.sum(F.when(F.col("severity") == "high", F.col("flagged_count"))), F.lit(0)).cast("long").alias("high"),
        F.coalesce(F.sum(F.when(F.col("severity") == "medium", F.col("flagged_count"))), F.lit(0)).cast("long").alias("medium"),
    )


def review_kpis(flagged: DataFrame) -> DataFrame:
    """Flagged rows, high-priority rows, distinct issue types and issue columns."""
    cols = flagged.columns
    sev = F.lower(F.col("severity")) if "severity" in cols else F.lit("unknown")
    aggs = [F.count(F.lit(1)).alias("flagged_rows"), F.count_if(sev == "high").alias("high_priority")]
    aggs.append(F.count_distinct("issue_type").alias("issue_types") if "issue_type" in cols
                else F.lit(0).cast("long").alias("issue_types"))
    aggs.append(F.count_distinct("issue_column").alias("issue_columns") if "issue_column" in cols
                else F.lit(len(cols)).cast("long").alias("issue_columns"))
    return flagged.agg(*aggs)


def severity_mix(flagged: DataFrame) -> DataFrame:
    sev = F.lower(F.coalesce(F.col("severity"), F.lit("unknown"))) if "severity" in flagged.columns else F.lit("unknown")
    return flagged.groupBy(sev.alias("severity")).agg(F.count(F.lit(1)).alias("rows"))


def review_queue(flagged: DataFrame, top: int | None = None) -> DataFrame:
    """Reviewer work queue: the display columns that exist, highest severity first when ``top`` is given."""
    wanted = ["severity", "issue_type", "issue_column", "record_id", "patient_id", "source", "field_name", "drafted_query"]
    cols = [c for c in wanted if c in flagged.columns] or flagged.columns
    queue = flagged.select(*cols)
    if top is not None:
        rank = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
        queue = queue.orderBy(rank, *[F.col(c) for c in cols if c != "severity"]).limit(top)
    return queue


def rule_hit_coverage(rules: DataFrame, issues: DataFrame) -> DataFrame:
    """Per rule: type, whether the engine implements it, enabled flag and issues raised.

    ``rules`` is the rules table (one row per rule, small config); ``issues``
    is aggregated to one row per rule id before the join.
    """
    hits = issues.groupBy("rule_id").agg(F.count(F.lit(1)).alias("hits"))
    return (rules.join(hits, rules["id"].eqNullSafe(hits["rule_id"]), "left")
            .select(rules["id"].alias("rule_id"), "type", "implemented", "enabled",
                    F.coalesce(F.col("hits"), F.lit(0)).cast("long").alias("hits")))


def rule_type_coverage(hits: DataFrame) -> DataFrame:
    """Per (type, implemented): rules and the issues they raised, from ``rule_hit_coverage``."""
    return hits.groupBy("type", "implemented").agg(F.count(F.lit(1)).alias("rules"), F.sum("hits").alias("hits"))
