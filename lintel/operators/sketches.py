"""Distinct-count sketches that are kept and merged (H2, R6).

One HyperLogLog sketch per part of a table and column, a few kilobytes each whatever
the part's size.  Sketches of different parts merge into the sketch of all of them,
so a profile or a cardinality rule is brought up to date by reading new parts only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lintel.operators.stats import colref, distinct_text

LG_K = 14                                   # 2 ** 14 registers
STANDARD_ERROR = 1.04 / (2 ** LG_K) ** 0.5  # relative, of one estimate


def column_sketches(df: DataFrame, part: Column, columns: Sequence[str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """``part, column, null_count, non_null, sketch``: one row per part (text) and column.

    One scan and one map-side aggregate: a task passes on one sketch per part and column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (columns or df.columns) if not isinstance(types[c], T.BinaryType)]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), distinct_text(colref(c), types[c]).alias("v")) for c in cols])
    long = df.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), F.inline(pairs))
    return long.groupBy("part", "column").agg(F.count_if(F.col("v").isNull()).alias("null_count"), F.count("v").alias("non_null"),
                                              F.hll_sketch_agg("v", lg_k).alias("sketch"))


def merge(states: Sequence[DataFrame]) -> DataFrame:
    """One state of several whose parts differ."""
    return reduce(DataFrame.unionByName, states)


def whole(state: DataFrame) -> DataFrame:
    """``column, null_count, non_null, sketch`` of all parts together."""
    return state.groupBy("column").agg(F.sum("null_count").alias("null_count"), F.sum("non_null").alias("non_null"), F.hll_union_agg("sketch").alias("sketch"))


def estimates(state: DataFrame) -> DataFrame:
    """``column, null_count, non_null, unique_estimate`` of all parts together (null is no value)."""
    return whole(state).select("column", "null_count", "non_null", F.hll_sketch_estimate("sketch").alias("unique_estimate"))


def distinct_counts(state: DataFrame, columns: Sequence[str], prefix: str = "d") -> DataFrame:
    """One row, ``{prefix}{i}`` per column: what ``stats.distinct_counts`` gives (null counts as a value), from the state alone."""
    found = estimates(state).withColumn("n", F.col("unique_estimate") + (F.col("null_count") > 0).cast("long"))
    return found.agg(*[F.coalesce(F.max(F.when(F.col("column") == c, F.col("n"))), F.lit(0)).cast("long").alias(f"{prefix}{i}") for i, c in enumerate(columns)])


def save(state: DataFrame, path: str) -> None:
    """Keep a state; parts that it holds replace those kept before, other parts stay."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    schema = "column string, null_count long, non_null long, sketch binary, part string"
    return spark.read.schema(schema).parquet(path).select("part", "column", "null_count", "non_null", "sketch")
