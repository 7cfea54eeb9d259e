"""The fixed clinical check (C1-C9), in DataFrame form and SQL form.

One issue per record, first match wins:
missing value > unit mismatch > duplicate measurement > stale data > out of range.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lintel import config
from lintel.functions.columns import protect_reserved
from lintel.operators.groups import attach_group_count

SQL_DIR = Path(__file__).resolve().parent.parent / "plans" / "sql"
COPIES = "__lintel_copies"
DUPLICATE_KEYS = ("patient_id", "source", "field_name")
ISSUE_ORDER = ("missing_value", "unit_mismatch", "duplicate_measurement", "stale_data", "out_of_range")


def clinical_conditions(review_date: str = config.REVIEW_DATE, stale_days: int = config.STALE_DATA_DAYS,
                        dup_col: str = COPIES) -> dict[str, Column]:
    value, low, high = F.col("value"), F.col("ref_low"), F.col("ref_high")
    return {
        "missing_value": value.isNull(),
        "unit_mismatch": F.col("unit").isNotNull() & F.col("expected_unit").isNotNull()
                         & (F.col("unit") != F.col("expected_unit")),
        "duplicate_measurement": F.col(dup_col) > 1,
        "stale_data": F.datediff(F.to_date(F.lit(review_date)), F.col("data_received_date")) > F.lit(stale_days),
        "out_of_range": low.isNotNull() & high.isNotNull() & ((value < low) | (value > high)),
    }


def with_duplicate_count(records: DataFrame, out_col: str = COPIES, **kw) -> DataFrame:
    return attach_group_count(records, DUPLICATE_KEYS, out_col, **kw)


def run_checks_dataframe(records: DataFrame, review_date: str = config.REVIEW_DATE,
                         stale_days: int = config.STALE_DATA_DAYS, **kw) -> DataFrame:
    """Flagged records with one ``issue_type`` each (priority pick)."""
    records = protect_reserved(records)
    checked = with_duplicate_count(records, **kw)
    conds = clinical_conditions(review_date, stale_days)
    pick = None
    for name in ISSUE_ORDER:
        pick = F.when(conds[name], F.lit(name)) if pick is None else pick.when(conds[name], F.lit(name))
    return (checked.withColumn("issue_type", pick)
            .where(F.col("issue_type").isNotNull())
            .drop(COPIES))


def run_checks_long(records: DataFrame, review_date: str = config.REVIEW_DATE,
                    stale_days: int = config.STALE_DATA_DAYS, **kw) -> DataFrame:
    """Every clinical issue of every record (the priority pick shows only the first)."""
    records = protect_reserved(records)
    checked = with_duplicate_count(records, **kw)
    conds = clinical_conditions(review_date, stale_days)
    empty = F.array().cast("array<string>")
    issues = F.concat(*[F.when(conds[n], F.array(F.lit(n))).otherwise(empty) for n in ISSUE_ORDER])
    return (checked.withColumn("__issues", issues)
            .select(*records.columns, F.explode_outer("__issues").alias("issue_type"))
            .where(F.col("issue_type").isNotNull()))


def run_checks_sql(spark: SparkSession, records: DataFrame, review_date: str = config.REVIEW_DATE,
                   stale_days: int = config.STALE_DATA_DAYS, sql_path: str | Path | None = None) -> DataFrame:
    text = Path(sql_path or SQL_DIR / "clinical_checks.sql").read_text(encoding="utf-8")
    return spark.sql(text, args={"review_date": review_date, "stale_days": int(stale_days)}, records=records)


PAIR = ("record_id", "issue_type")


def signed_counts(a: DataFrame, b: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """``keys, in_a, in_b``: how often each key occurs on both sides; null keys meet null keys.

    The sides are stacked with a sign and counted in one exchange, map-side first, so a
    key that fills a third of a side costs one row per task.
    """
    marked = [side.select(*keys, F.lit(sign).alias("sign")) for side, sign in ((a, 1), (b, -1))]
    return marked[0].unionAll(marked[1]).groupBy(*keys).agg(F.count_if(F.col("sign") > 0).alias("in_a"), F.count_if(F.col("sign") < 0).alias("in_b"))


def multiset_difference(a: DataFrame, b: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """``keys, surplus``: by how many rows ``a`` has more (negative: fewer) than ``b``; equal counts are left out."""
    met = signed_counts(a, b, keys)
    return met.where(F.col("in_a") != F.col("in_b")).select(*keys, (F.col("in_a") - F.col("in_b")).alias("surplus"))


def cross_validate_frame(df_result: DataFrame, sql_result: DataFrame) -> DataFrame:
    """One row: rows only in the DataFrame result, only in the SQL result, and in both, as multisets of (record_id, issue_type)."""
    a, b, zero = F.col("in_a"), F.col("in_b"), F.lit(0).cast("long")
    return signed_counts(df_result, sql_result).agg(*[F.coalesce(F.sum(x), zero).alias(name) for x, name in (
        (F.greatest(a - b, zero), "only_dataframe"), (F.greatest(b - a, zero), "only_sql"), (F.least(a, b), "in_both"))])


def cross_validate(df_result: DataFrame, sql_result: DataFrame, show: int = 20) -> bool:
    """Raise when the two forms disagree, listing up to ``show`` differing pairs with their surplus."""
    differ = multiset_difference(df_result, sql_result)
    found = differ.orderBy(*PAIR).limit(show).collect()
    if found:
        raise AssertionError("DataFrame and SQL checks disagree; (record, issue, surplus of the DataFrame form), the first ones: "
                             f"{[tuple(r) for r in found]}")
    return True
