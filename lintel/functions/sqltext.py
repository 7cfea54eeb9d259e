"""Spark SQL text for compiled checks.

Rules over wide tables compile to thousands of small expressions; building
them as SQL text and handing the whole issue expression to the JVM in one
``expr`` call keeps plan construction fast (one parse instead of thousands of
Python-to-JVM calls).  Only quoting helpers and a few typed probes live here;
Spark's own parser does the parsing.
"""

from __future__ import annotations

import math

from pyspark.sql import types as T

from lintel.functions.values import DATE_TYPES, NUMERIC_TYPES, is_complex


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def field(struct_col: str, name: str) -> str:
    return f"{ident(struct_col)}.{ident(name)}"


def string(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    x = float(value)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{x!r}D"


def blank(c: str, dtype: T.DataType | None = None) -> str:
    """Null, or (text only) empty after trimming spaces; a number or date is never blank text."""
    if dtype is not None and not isinstance(dtype, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
        return f"({c} IS NULL)"
    return f"({c} IS NULL OR trim(CAST({c} AS STRING)) = '')"


def as_double(c: str, dtype: T.DataType) -> str | None:
    if isinstance(dtype, NUMERIC_TYPES + (T.BooleanType,)):
        return f"CAST({c} AS DOUBLE)"
    if isinstance(dtype, T.StringType):
        return f"TRY_CAST({c} AS DOUBLE)"
    return None


def as_date(c: str, dtype: T.DataType) -> str | None:
    if isinstance(dtype, DATE_TYPES):
        return f"to_date({c})"
    if isinstance(dtype, T.StringType):
        return f"try_to_date({c})"
    if is_complex(dtype):
        return None
    return f"try_to_date(CAST({c} AS STRING))"


def as_text(c: str, dtype: T.DataType) -> str:
    return c if isinstance(dtype, T.StringType) else f"CAST({c} AS STRING)"
