"""A bounded, deterministic preview: the bottom-k sketch of a table's rows.

Every row gets a 128-bit key from its content, and the preview is the rows with the
smallest keys.  It depends on nothing but the rows: not on files, partitions,
executors or retries.  Each task keeps its own smallest rows and only those
meet in one merge, so the work is one scan and ``tasks x rows`` rows move.  Keys are
kept beside the rows, so the previews of two parts of a table merge into the preview
of the whole, and the largest key kept estimates how many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lintel.operators.stats import colref, distinct_text

KEY = "preview_key"
FRACTION = "preview_fraction"
_HEX = 13                     # hex digits of a key that fit a double exactly


def row_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hex text of 128 bits over the named columns: ``-`` for null, else the byte count, a colon and the value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in columns or df.columns:
        text = F.base64(colref(c)) if isinstance(types[c], T.BinaryType) else distinct_text(colref(c), types[c])
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.md5(F.concat(*parts))


def bottom_k(df: DataFrame, rows: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``rows`` rows of smallest key, with their keys; equal rows have equal keys and may all be kept."""
    if KEY in (c.lower() for c in df.columns):
        raise ValueError(f"column {KEY} is reserved")
    return df.select("*", row_key(df, columns).alias(KEY)).orderBy(KEY).limit(int(rows))


def merge(sketches: Sequence[DataFrame], rows: int) -> DataFrame:
    """The sketch of all parts from the sketches of the parts, each taken with at least ``rows`` rows."""
    return reduce(DataFrame.unionByName, sketches).orderBy(KEY).limit(int(rows))


def estimated_rows(sketch: DataFrame, rows: int) -> DataFrame:
    """One row, ``rows``: about how many different rows the sketched table has (exact when it has fewer than asked)."""
    share = (F.conv(F.substring(F.max(KEY), 1, _HEX), 16, 10).cast("double") + 1) / F.lit(float(16 ** _HEX))
    n = F.count_distinct(KEY)
    return sketch.agg(F.when(F.count(F.lit(1)) < int(rows), n.cast("double")).otherwise((n - 1) / share).alias("rows"))


def preview(df: DataFrame, rows: int, columns: Sequence[str] | None = None) -> DataFrame:
    """At most ``rows`` rows of ``df`` and ``preview_fraction``, the share of all rows that they are."""
    total = df.agg(F.count(F.lit(1))).scalar()
    kept = bottom_k(df, rows, columns).drop(KEY)
    return kept.select("*", F.least(F.lit(1.0), F.lit(float(rows)) / total).alias(FRACTION))
