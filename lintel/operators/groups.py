"""Rows-per-key counts attached back to every row, safe under key skew.

``count(*) over (partition by key)`` sends every row of a key to one task; a
key holding a third of the table then becomes a third of the job in one
task.  Instead:

1. ``groupBy(key).count()`` - partial aggregation on the map side, so a hot
   key costs one row per map task in the shuffle.
2. Hot keys are those holding more than ``hot_fraction`` of all rows,
   at every table size.  There can be at most ``1 / hot_fraction`` of
   them, so that table has a proven size bound and is broadcast: hot rows get
   their count map-side, without moving.
3. Remaining keys with a count above one are joined back with a shuffle join.
   Hot rows still pass through that shuffle (the plan reads the input once),
   but with a null key and a salt, so they are scattered and match nothing.
   The salt is a hash of the row's fixed-width columns (numbers, booleans,
   dates) - cheap to read, so long text columns are not pulled into a scan
   that does not otherwise need them, and the same on every task retry
   whatever the input order, so a recomputed map task sends each row to the
   same reducer.  Rows that share those values (exact copies, or a table with
   no fixed-width column) share a salt; AQE's skew-join split (which splits a
   large reducer partition by map output, deterministically) covers them and
   moderately skewed cold keys.  AQE also turns the join into a
   broadcast at run time when the duplicate set turns out small.

Null keys form one group (null-safe matching), like ``GROUP BY``.  Unique keys
get a null count: callers test ``count > 1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

DEFAULT_HOT_FRACTION = 1e-3      # fewer than 1,000 hot keys can exist


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _key_columns(keys: Sequence[str], prefix: str) -> list:
    """Null-safe join keys: (is null, value) per key column."""
    out = []
    for i, k in enumerate(keys):
        out.append(F.col(_q(k)).isNull().alias(f"{prefix}n{i}"))
        out.append(F.col(_q(k)).alias(f"{prefix}v{i}"))
    return out


def group_counts(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    return df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias(count_col))


def attach_group_count(df: DataFrame, keys: Sequence[str], out_col: str, *,
                       hot_fraction: float = DEFAULT_HOT_FRACTION,
                       salts: int | None = None, strategy: str = "join",
                       counts_from: DataFrame | None = None) -> DataFrame:
    """``strategy="window"`` is one scan and one exchange, for keys known not to be skewed
    (a hot key then lands in one task); the default ``"join"`` is skew-safe.  ``counts_from`` is the
    frame to count when ``df`` already carries joined helper columns, so that several counts add up
    their plans instead of multiplying them."""
    keys = list(keys)
    if strategy == "window":
        from pyspark.sql import Window
        n = F.count(F.lit(1)).over(Window.partitionBy(*[F.col(_q(k)) for k in keys]))
        return df.withColumn(out_col, F.when(n > 1, n))
    if strategy != "join":
        raise ValueError(f"unknown duplicate strategy {strategy!r}")
    spark = df.sparkSession
    if salts is None:
        # Hot rows match nothing, so many salts cost nothing and spread evenly.
        salts = 64 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    tag = out_col.replace(".", "_")
    counts = group_counts(df if counts_from is None else counts_from, keys, "__n")
    total = counts.agg(F.sum("__n").alias("t")).scalar()
    threshold = total * F.lit(float(hot_fraction))

    # Hot keys: <= 1/hot_fraction rows by construction -> broadcast.
    hot = counts.where(F.col("__n") > threshold).select(
        *[F.col(_q(k)).alias(f"__h{tag}_{i}") for i, k in enumerate(keys)], F.col("__n").alias(f"__hn{tag}"))
    hot_cond = None
    for i, k in enumerate(keys):
        c = df[_q(k)].eqNullSafe(hot[f"__h{tag}_{i}"])
        hot_cond = c if hot_cond is None else hot_cond & c
    tagged = df.join(F.broadcast(hot), hot_cond, "left").drop(*[f"__h{tag}_{i}" for i in range(len(keys))])

    # Cold duplicate keys, joined on (null flag, value, salt); hot rows get a null key and a spread salt.
    hot_n = F.col(f"__hn{tag}")
    cold = counts.where((F.col("__n") > 1) & (F.col("__n") <= threshold)).select(
        # The salt is always 0 but comes from the count: a literal would be folded into a one-sided
        # condition and the exchange would lose it, which sends all hot rows to one task.
        *_key_columns(keys, f"__c{tag}"), F.pmod(F.col("__n"), F.lit(1)).cast("int").alias(f"__cs{tag}"),
        F.col("__n").alias(f"__cn{tag}"))
    left_keys = []
    for i, k in enumerate(keys):
        left_keys.append(F.when(hot_n.isNull(), F.col(_q(k)).isNull()).alias(f"__l{tag}n{i}"))
        left_keys.append(F.when(hot_n.isNull(), F.col(_q(k))).alias(f"__l{tag}v{i}"))
    fixed = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
             T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    hashable = [F.col(_q(f.name)) for f in df.schema.fields if isinstance(f.dataType, fixed)]
    if not hashable:  # text-only tables: spread by whatever can be hashed
        hashable = [F.col(_q(f.name)) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int") if hashable else F.lit(0)
    salt = F.when(hot_n.isNull(), F.lit(0)).otherwise(spread).alias(f"__l{tag}s")
    left = tagged.select("*", *left_keys, salt)
    cond = left[f"__l{tag}s"] == cold[f"__cs{tag}"]
    for i in range(len(keys)):
        cond = cond & (left[f"__l{tag}n{i}"] == cold[f"__c{tag}n{i}"])
        cond = cond & (left[f"__l{tag}v{i}"].eqNullSafe(cold[f"__c{tag}v{i}"]))
    joined = left.join(cold, cond, "left")
    helper = ([f"__l{tag}n{i}" for i in range(len(keys))] + [f"__l{tag}v{i}" for i in range(len(keys))]
              + [f"__c{tag}n{i}" for i in range(len(keys))] + [f"__c{tag}v{i}" for i in range(len(keys))]
              + [f"__l{tag}s", f"__cs{tag}"])
    return (joined.withColumn(out_col, F.coalesce(hot_n, F.col(f"__cn{tag}")))
            .drop(*helper, f"__hn{tag}", f"__cn{tag}"))
