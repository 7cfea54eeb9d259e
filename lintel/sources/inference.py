"""Column types of text tables, found as a fold over a lattice of types (S2).

For every value the types it converts to are a set of bits; a column's types are the
``bit_and`` over its values.  The fold is associative and commutative, so it is one
map-side aggregate over any source, whole and independent of file order.  The
narrowest type left is the column's; a blank value converts to every type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lintel.functions.values import NUMBER_SHAPE
from lintel.operators.stats import colref

# Narrowest first; a type's bit is its place.
LADDER = ("boolean", "bigint", "double", "date", "timestamp")
ALL = 2 ** len(LADDER) - 1

INTEGER_SHAPE = r"^[+-]?\d{1,18}$"
DATE_ONLY = r"^\d{4}-\d{1,2}-\d{1,2}$"
DATE_AND_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"


def type_bits(text: Column) -> Column:
    """The types that one value converts to; all of them for null and blank."""
    t = F.trim(text)
    date = t.rlike(DATE_ONLY) & F.try_to_date(t).isNotNull()
    tests = (F.lower(t).isin("true", "false"), t.rlike(INTEGER_SHAPE), t.rlike(NUMBER_SHAPE) & t.try_cast("double").isNotNull(),
             date, date | (t.rlike(DATE_AND_TIME) & t.try_cast("timestamp_ntz").isNotNull()))
    bits = sum((F.when(test, 2 ** i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))
    return F.when(text.isNull() | (t == ""), ALL).otherwise(bits)


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, position, inferred_type, filled, bits``: one row per column of a text table."""
    cols = list(columns or df.columns)
    one = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.bit_and(type_bits(colref(c).cast("string"))), F.lit(ALL)).alias("bits"),
                                    F.count_if(F.trim(colref(c).cast("string")) != "").alias("filled")) for c in cols]).alias("s"))
    rows = one.select(F.posexplode("s").alias("position", "f")).select("position", "f.*")
    kind = F.lit("string")
    for i in range(len(LADDER) - 1, -1, -1):
        kind = F.when(F.col("bits").bitwiseAND(2 ** i) != 0, LADDER[i]).otherwise(kind)
    return rows.select("column", "position", F.when(F.col("filled") == 0, "string").otherwise(kind).alias("inferred_type"), "filled", "bits")


def typed(df: DataFrame) -> DataFrame:
    """``df`` with every text column converted to the type that all its values have; blank values become null.

    Only one small row per column reaches the driver, to fix the plan's types.
    """
    text = [c for c, kind in df.dtypes if kind == "string"]
    if not text:
        return df
    found = {r["column"]: r["inferred_type"] for r in infer_types(df, text).collect()}
    names = {"timestamp": "timestamp_ntz"}

    def convert(c):
        kind = found.get(c, "string")
        return colref(c) if kind == "string" else F.trim(colref(c)).try_cast(names.get(kind, kind)).alias(c)

    return df.select(*[convert(c) for c in df.columns])
