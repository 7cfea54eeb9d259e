"""Quartiles for IQR outlier bounds: exact in two scans, or approximate.

Exact mode computes linear-interpolated quantiles (position ``p * (n - 1)``,
as ``percentile``/``quantile_cont``); no task ever holds a column:

1. One scan fills a quantile sketch per group (``percentile_approx``, whose ranks are
   off by at most ``1 / ACCURACY`` of the values).  Its values at ``p`` minus and plus
   twice that error enclose the asked quantile, and few others.
2. One more scan counts.  Values inside an interval are counted one by one, the
   values between two intervals together, with their least and greatest.  Both
   happen map-side, so only about ``4 / ACCURACY`` of the values are shuffled per
   asked quantile, whatever their number.
3. The counts hold every exact rank.  A histogram of 65,536 even bins per interval finds
   the bin of an asked rank, and the values of that bin are put in order.

The result does not depend on the sketch: the counts are exact, and a rank that fell
outside its interval would stop the query with an error.  Sketches and bins are
functions of the values and the group, so reruns agree whether or not Spark reuses an
exchange.  Only intervals and kept bins (groups x ranks, bounded by schema and
configuration) are broadcast.

Approximate mode is ``percentile_approx`` with accuracy ``1 / relative error``
(0.05 -> 20, the sketch error of the reviewed application).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ACCURACY = 10_000   # the sketch's ranks are off by at most 1 / ACCURACY of the values
FINE = 65_536       # bins of one interval


def _holding(cells: DataFrame, order: str) -> DataFrame:
    """Of the cells ``(g, k, rank, c, ..)`` of every asked rank, the one that holds it; ``rank`` counts from its start."""
    before = Window.partitionBy("g", "k").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("c").over(before), F.lit(0))
    inside = (F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("c"))
    return cells.withColumn("start", start).where(inside).withColumn("rank", F.col("rank") - F.col("start"))


def exact_quantiles_grouped(long: DataFrame, group: str, x: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """Per ``group``: columns ``{prefix}0..`` with the exact quantiles of ``x`` (non-null values; NaN is the greatest)."""
    values = long.select(F.col(group).alias("g"), F.col(x).cast("double").alias("x")).where(F.col("x").isNotNull())
    margin = 2.0 / ACCURACY
    ends = sorted([max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs])
    sketch = values.groupBy("g").agg(F.percentile_approx("x", ends, ACCURACY).alias("ends")).select(F.col("g").alias("sg"), "ends")

    # A value's slot is the number of ends below it; the slots of one interval hold its values, the others those between intervals.
    met = values.join(F.broadcast(sketch), F.col("g").eqNullSafe(F.col("sg")))
    slot = sum((F.when(F.col("ends")[j] < F.col("x"), 1).otherwise(0) for j in range(len(ends))), F.lit(0))
    lows = [ends.index(max(0.0, p - margin)) for p in probs]
    highs = [len(ends) - 1 - ends[::-1].index(min(1.0, p + margin)) for p in probs]
    asked_for = F.lit(False)
    for lo, hi in zip(lows, highs, strict=True):
        asked_for = asked_for | ((F.col("x") >= F.col("ends")[lo]) & (F.col("x") <= F.col("ends")[hi]))
    low, high = F.get("ends", F.col("slot") - 1), F.get("ends", F.col("slot"))
    share = F.try_divide(F.col("x") - low, high - low)
    fine = F.when(share.isNull() | F.isnan(share), 0).otherwise(F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * FINE))
    met = met.withColumn("slot", slot).withColumn("inside", asked_for)
    met = met.select("g", "x", F.when(F.col("inside"), F.col("x")).alias("v"),
                     (F.col("slot").cast("long") * (4 * FINE) + F.when(F.col("inside"), fine + 1).otherwise(0)).alias("bin"))
    cells = met.groupBy("g", "bin", "v").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))

    bins = cells.groupBy("g", "bin").agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    bins = bins.withColumn("n", F.sum("c").over(Window.partitionBy("g")))
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    # Each prob asks for the ranks around its position; they are often the same.
    asked = F.array(*[F.struct(F.lit(2 * i + up).alias("k"), (F.ceil(pos) if up else F.floor(pos)).cast("long").alias("rank"))
                      for i, pos in enumerate(at) for up in (0, 1)])
    kept = _holding(bins.select("g", "bin", "c", "n", F.inline(asked)), "bin")
    kept = kept.select(F.col("g").alias("kg"), F.col("bin").alias("kbin"), "k", "rank", "n")
    # Null-safe on both keys: a plain equality would push a null test below the aggregate in this
    # branch alone, and the scan would be repeated instead of its exchange reused.
    within = cells.join(F.broadcast(kept), F.col("g").eqNullSafe(F.col("kg")) & F.col("bin").eqNullSafe(F.col("kbin")))
    found = _holding(within.select("g", "k", "rank", "n", "c", "lo", "hi"), "lo")
    missed = F.raise_error(F.lit("a quantile lies outside the interval of its sketch")).cast("double")
    value = F.when((F.col("rank") == 0) | (F.col("lo") == F.col("hi")), F.col("lo")).when(F.col("rank") == F.col("c") - 1, F.col("hi")).otherwise(missed)

    got = found.groupBy("g").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("k") == k, value)).alias(f"__r{k}") for k in range(2 * len(probs))])
    out = []
    for i, pos in enumerate(at):
        frac, lo, hi = pos - F.floor(pos), F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        out.append(F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac).alias(f"{prefix}{i}"))
    return got.select(F.col("g").alias(group), *out)


def exact_quantiles(df: DataFrame, x: Column, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """One-row DataFrame with the exact quantiles of ``x`` (nulls when ``x`` has no values)."""
    long = df.select(F.lit(0).alias("__g"), x.cast("double").alias("__x"))
    per = exact_quantiles_grouped(long, "__g", "__x", probs, prefix)
    # Aggregate to exactly one row even when the column has no values.
    return per.agg(*[F.max(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range(len(probs))])


def approx_quantiles(x: Column, probs: Sequence[float], relative_error: float) -> Column:
    """Aggregate expression: array of approximate quantiles of ``x``."""
    accuracy = max(1, int(round(1.0 / relative_error))) if relative_error > 0 else 1_000_000
    return F.percentile_approx(x.cast("double"), [float(p) for p in probs], accuracy)
