"""ANSI-safe value probes shared by rules, the clinical check and the profiler.

Spark 4 runs with ANSI mode on, where ``cast``/``to_date`` raise on bad input.
Rules pick columns by name pattern, so a numeric or date rule may land on a
column of any type; every probe here returns null instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
COMPLEX_TYPES = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)

# The date shape searched for in a value
# (yyyy-m-d or yyyy/m/d, or m-d-yy(yy) / m/d/yy(yy)).
DATE_SHAPE = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}"

# A plain decimal number with optional sign, exponent and surrounding spaces.
NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_complex(dtype: T.DataType) -> bool:
    return isinstance(dtype, COMPLEX_TYPES)


def blank(col: Column, dtype: T.DataType | None = None) -> Column:
    """Null, or (text only) empty after trimming spaces (Spark ``trim`` strips spaces only)."""
    if dtype is not None and not isinstance(dtype, (T.StringType, T.BinaryType) + COMPLEX_TYPES):
        return col.isNull()
    return col.isNull() | (F.trim(col.cast("string")) == F.lit(""))


def as_double(col: Column, dtype: T.DataType) -> Column | None:
    """Double view of a column; null where a string does not parse; None if the type cannot be numeric."""
    if isinstance(dtype, NUMERIC_TYPES):
        return col.cast("double")
    if isinstance(dtype, T.BooleanType):
        return col.cast("double")
    if isinstance(dtype, T.StringType):
        return col.try_cast("double")
    return None


def as_date(col: Column, dtype: T.DataType) -> Column | None:
    """Date view of a column; null where a value does not parse; None for nested/binary types."""
    if isinstance(dtype, DATE_TYPES):
        return F.to_date(col)
    if isinstance(dtype, T.StringType):
        return F.try_to_date(col)
    if is_complex(dtype):
        return None
    return F.try_to_date(col.cast("string"))


def probe_date(text: Column) -> Column:
    """Lenient date parse of text: ISO first, then y/m/d, then m/d/y; null if none fits."""
    return F.coalesce(
        F.try_to_date(text),
        F.try_to_date(text, "yyyy/M/d"),
        F.try_to_date(text, "M/d/yyyy"),
    )


def looks_numeric(text: Column) -> Column:
    """Text that parses as a number (regex gate first, so '12d' does not count)."""
    return text.rlike(NUMBER_SHAPE) & text.try_cast("double").isNotNull()


def as_text(col: Column, dtype: T.DataType) -> Column:
    """String rendering used for blank tests, allowed values and formats."""
    if isinstance(dtype, T.StringType):
        return col
    return col.cast("string")
