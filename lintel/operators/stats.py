"""Whole-table statistics that some rules need, as one-row DataFrames.

The rule engine reads them into the row pass as scalar subqueries, so the
statistics are computed once, before the row pass, and nothing but the one
row ever reaches the driver-side plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def colref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def distinct_text(col: Column, dtype: T.DataType) -> Column:
    """A string key with the same equality as Spark's grouping (-0.0 equals 0.0)."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col.cast("double"))
    if isinstance(dtype, (T.MapType, T.ArrayType, T.StructType)):  # plain text would merge ["a, b"] and ["a", "b"]
        col = F.to_json(col)
    return col.cast("string")


def distinct_counts(df: DataFrame, columns: Sequence[str], prefix: str = "d") -> DataFrame:
    """Exact distinct values per column, null counted as a value (like ``distinct().count()``).

    One unpivot to (column index, value) -> group by both (partial aggregation
    map-side, so hot values cost one row per task) -> count per column.
    Output: one row, ``{prefix}{i}`` per column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), distinct_text(colref(c), types[c]).alias("v"))
                      for i, c in enumerate(columns)])
    long = df.select(F.inline(pairs))
    per_value = long.groupBy("k", "v").count()
    per_col = per_value.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return per_col.agg(*[F.coalesce(F.max(F.when(F.col("k") == i, F.col("n"))), F.lit(0)).cast("long").alias(f"{prefix}{i}")
                         for i in range(len(columns))])
