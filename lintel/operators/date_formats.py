"""Date formats of text columns, mined from the shapes of all their values (H5).

Every value becomes a mask (a digit is 9, a run of letters is a); masks are counted
map-side, so the shuffle carries a few short masks and no value.  Masks of one family
(year first or last, one separator, with or without a time) are folded: the numbers
in them say whether the day or the month comes first.  The family that most values of a
column have is its format, with its share; the first value decides nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from lintel.operators.stats import colref

LONGEST = 40          # characters of the longest value that can be a date; longer ones count as values without a format
LEAST_SHARE = 0.5     # of a column's values that must have the format

YEAR_FIRST = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?:[ T]\d{1,2}:\d{2}.*)?$"
YEAR_LAST = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})(?:[ T]\d{1,2}:\d{2}.*)?$"


def shapes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, mask, values, first_high, second_high``: values per mask; how many have a first or second short number above 12.

    ``mask`` is null for values too long to be dates.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (columns or df.columns) if isinstance(types[c], T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, mask string, values long, first_high long, second_high long")
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.trim(colref(c)).alias("v")) for c in cols]))).where(F.col("v") != "")
    v = F.col("v")
    short = F.when(F.length(v) <= LONGEST, v)
    mask = F.regexp_replace(F.regexp_replace(short, r"\d", "9"), r"\p{L}+", "a")
    first = F.when(short.rlike(YEAR_FIRST), F.regexp_extract(short, YEAR_FIRST, 3)).when(short.rlike(YEAR_LAST), F.regexp_extract(short, YEAR_LAST, 1))
    second = F.when(short.rlike(YEAR_FIRST), F.regexp_extract(short, YEAR_FIRST, 4)).when(short.rlike(YEAR_LAST), F.regexp_extract(short, YEAR_LAST, 3))
    return long.select("column", mask.alias("mask"), first.cast("int").alias("a"), second.cast("int").alias("b")).groupBy("column", "mask").agg(
        F.count(F.lit(1)).alias("values"), F.count_if(F.col("a") > 12).alias("first_high"), F.count_if(F.col("b") > 12).alias("second_high"))


def date_formats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, date_format, field_order, share, values``: one row per text column with values.

    ``field_order`` is ``known``, ``assumed`` (no number above 12 tells day and month apart: after
    a dot the day comes first, else the month) or ``mixed`` (some values only fit one order, some only the
    other; the more frequent one is given).  Columns without a dominant date format have null for both.
    """
    m = F.col("mask")
    mask_first, mask_last = r"^9999([-/.])9{1,2}\1(9{1,2})", r"^9{1,2}([-/.])9{1,2}\1(9999)"
    masked = lambda shape: shape.replace(r"\d", "9").replace("[ T]", "[ a]")
    year = F.when(m.rlike(masked(YEAR_FIRST)), "first").when(m.rlike(masked(YEAR_LAST)), "last")
    sep = F.when(F.col("year") == "first", F.regexp_extract(m, mask_first, 1)).when(F.col("year") == "last", F.regexp_extract(m, mask_last, 1))
    time = F.when(F.col("year").isNotNull(), F.when(m.contains("a9"), "'T'").when(m.contains(" "), " ").otherwise(""))
    found = shapes(df, columns).withColumn("year", year).withColumn("sep", sep).withColumn("time", time)
    families = found.groupBy("column", "year", "sep", "time").agg(*[F.sum(c).alias(c) for c in ("values", "first_high", "second_high")])

    # At most a few dozen families per column.
    best = Window.partitionBy("column").orderBy(F.col("year").isNull(), F.desc("values"), "year", "sep", "time")
    ranked = families.withColumn("total", F.sum("values").over(Window.partitionBy("column"))).withColumn("rn", F.row_number().over(best)).where("rn = 1")
    a, b, last = F.col("first_high"), F.col("second_high"), F.col("year") == "last"
    day_first = F.when(last, F.when((a == 0) & (b == 0), F.col("sep") == ".").otherwise(a > b)).otherwise(a > b)
    order = (F.when((a > 0) & (b > 0), "mixed").when((a == 0) & (b == 0) & last, "assumed").otherwise("known"))
    fields = (F.when(last & day_first, F.array(*map(F.lit, ("d", "M", "yyyy")))).when(last, F.array(*map(F.lit, ("M", "d", "yyyy"))))
              .when(day_first, F.array(*map(F.lit, ("yyyy", "d", "M")))).otherwise(F.array(*map(F.lit, ("yyyy", "M", "d")))))
    text = F.concat(F.array_join(fields, "\0"), F.when(F.col("time") == "", "").otherwise(F.concat("time", F.lit("H:mm"))))
    share = F.when(F.col("year").isNotNull(), F.col("values") / F.col("total")).otherwise(0.0)
    ok = share > LEAST_SHARE
    return ranked.select("column", F.when(ok, F.replace(text, F.lit("\0"), F.col("sep"))).alias("date_format"), F.when(ok, order).alias("field_order"),
                         F.round(share, 6).alias("share"), F.col("total").alias("values"))
