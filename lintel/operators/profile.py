"""Column profile of a whole table without moving its values (H1-H8, H11, H15).

Three paths, each one scan:

* null, number and date probes and the least value per hash bucket: one aggregate
  without keys, one row per task;
* distinct values: numbers and times of fixed width, else 128-bit hashes, are grouped, so
  no text is shuffled;
* samples, the five smallest distinct non-null values (a row order does not exist in
  Spark): only values up to a bound that the first path found leave a task.

Fixed values (name patterns, matched from the start of the lower-cased name):
  id:          .*id$  ^id_.*  .*_id$  .*record.*id  .*patient.*id  .*user.*id
               .*customer.*id  .*account.*id  .*code$
  date:        .*date$  ^date_.*  .*_date$  .*timestamp  .*time$  .*created
               .*modified  .*received
  measurement: .*amount$  .*price$  .*value$  .*count$  .*rate$  .*percentage$
               .*score$  .*ref_.*  .*_low$  .*_high$  .*reference
Type thresholds: numeric when > 0.9 of non-null values parse as numbers
(confidence 0.95); date when > 0.5 have a date shape and > 0.7 parse
(0.95 with a date-like name, else 0.85); categorical when distinct/non-null
< 0.1 (0.8); id when > max(max_unique_ratio, 0.5) (0.7); text otherwise
(0.6); no values: unknown (0.5).  max_unique_ratio defaults to 0.1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from lintel.functions.values import DATE_SHAPE, DATE_TYPES, NUMERIC_TYPES, looks_numeric, probe_date
from lintel.operators.stats import colref

ID_PATTERNS = [r".*id$", r"^id_.*", r".*_id$", r".*record.*id", r".*patient.*id", r".*user.*id",
               r".*customer.*id", r".*account.*id", r".*code$"]
DATE_PATTERNS = [r".*date$", r"^date_.*", r".*_date$", r".*timestamp", r".*time$", r".*created",
                 r".*modified", r".*received"]
MEASUREMENT_PATTERNS = [r".*amount$", r".*price$", r".*value$", r".*count$", r".*rate$", r".*percentage$",
                        r".*score$", r".*ref_.*", r".*_low$", r".*_high$", r".*reference"]

SAMPLE_SIZE = 5
BUCKETS = 8              # more than SAMPLE_SIZE
SECOND_SEED = 40503      # of the second half of a value's hash


def anchored(patterns: Sequence[str]) -> str:
    return "^(?:" + "|".join(patterns) + ")"


def value_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col.cast("double"))
    if isinstance(dtype, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")


def column_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Schema metadata as a small table: position, name, storage type, type-based numeric flag."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = [(i, c, types[c].simpleString(), isinstance(types[c], NUMERIC_TYPES + (T.BooleanType,)),
             isinstance(types[c], DATE_TYPES)) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, physical_type string, typed_numeric boolean, typed_date boolean")


WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _storage(dtype: T.DataType) -> str:
    """How a value travels in the distinct path: as a whole number, a double or a time of fixed width, else as its hash."""
    if isinstance(dtype, WHOLE_TYPES):
        return "whole"
    for kind, types in (("flag", T.BooleanType), ("day", T.DateType), ("double", (T.FloatType, T.DoubleType)), ("time", (T.TimestampType, T.TimestampNTZType))):
        if isinstance(dtype, types):
            return kind
    return "hash"


def _texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The hashed columns as text ``t<position>`` with their bucket ``b<position>``, the others as they are, ``t<position>``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    hashed = [i for i, c in enumerate(columns) if _storage(types[c]) == "hash"]
    out = df.select(*[(value_text(colref(c), types[c]) if i in hashed else colref(c)).alias(f"t{i}") for i, c in enumerate(columns)])
    return out.select("*", *[F.pmod(F.hash(f"t{i}"), F.lit(BUCKETS)).alias(f"b{i}") for i in hashed])


def probes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, ``s``: per column the counts of nulls, values, number-like and date-like values, and a bound of the least values.

    One aggregate without keys: a task passes on one row.  Text probes run for text
    columns only; the storage type answers them for the others.  ``bound`` (text columns) is
    the fifth of the least values of ``BUCKETS`` hash buckets in order, so the five smallest
    distinct values do not exceed it.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for i, c in enumerate(columns):
        v, none, every = F.col(f"t{i}"), F.lit(0).cast("long"), F.count(f"t{i}")
        numeric, dated = isinstance(types[c], NUMERIC_TYPES + (T.BooleanType,)), isinstance(types[c], DATE_TYPES)
        if numeric or dated:
            found = [every if numeric else none, every if dated else none, every if dated else none]
        else:
            # Whatever parses as a date starts with a digit; the test spares the three parsers most texts.
            dateable = v.rlike(r"^\s*[+-]?\d")
            found = [F.count_if(looks_numeric(v)), F.count_if(v.rlike(DATE_SHAPE)), F.count_if(F.when(dateable, probe_date(v)).isNotNull())]
        bound = F.lit(None).cast("string")
        if _storage(types[c]) == "hash":
            # Nulls sort last, so fewer than five filled buckets give no bound.
            bound = F.get(F.array_sort(F.array(*[F.min(F.when(F.col(f"b{i}") == b, v)) for b in range(BUCKETS)])), F.lit(SAMPLE_SIZE - 1))
        fields.append(F.struct(F.count_if(v.isNull()).alias("null_count"), every.alias("non_null"),
                               *[x.alias(n) for x, n in zip(found, ("num_ok", "shape_ok", "date_ok"), strict=True)], bound.alias("bound")))
    return _texts(df, columns).agg(F.array(*fields).alias("s"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, a, b, d, t): the different non-null values, as fixed-width values of their type, else as 128 bits of hash.

    The shuffle carries these per different value and task, no text: a column of long
    texts costs what a column of numbers costs.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    empty = {"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long"), "d": F.lit(0.0), "t": F.lit(None).cast("timestamp_ntz")}
    structs = []
    for i, c in enumerate(columns):
        x, kind = colref(c), _storage(types[c])
        if kind == "hash":
            text = value_text(x, types[c])
            own = {"a": F.xxhash64(text), "b": F.xxhash64(F.lit(SECOND_SEED), text)}
        elif kind == "double":
            own = {"d": F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))}
        elif kind == "time":
            own = {"t": x.cast("timestamp_ntz")}
        else:
            own = {"a": (F.unix_date(x) if kind == "day" else x.cast("int") if kind == "flag" else x).cast("long")}
        fields = empty | own
        structs.append(F.struct(F.when(x.isNotNull(), F.lit(i)).alias("position"), *[fields[n].alias(n) for n in ("a", "b", "d", "t")]))
    return df.select(F.inline(F.array(*structs))).where(F.col("position").isNotNull()).distinct()


def distinct_by_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, unique_count)."""
    return distinct_values(df, columns).groupBy("position").agg(F.count(F.lit(1)).alias("unique_count"))


def _smallest(values: DataFrame) -> DataFrame:
    """(position, sample_values) of different (position, v)."""
    top = values.withColumn("rn", F.row_number().over(Window.partitionBy("position").orderBy("v"))).where(F.col("rn") <= SAMPLE_SIZE)
    return top.groupBy("position").agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "v"))), lambda s: s["v"]).alias("sample_values"))


def samples(df: DataFrame, columns: Sequence[str], probed: Column) -> DataFrame:
    """(position, sample_values): the five smallest distinct non-null values of every column, in the order of their texts.

    Fixed-width values come from the distinct path.  Of texts, those above the probes'
    ``bound`` (null in columns of few values: none) are left out, so only a handful leaves a task.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = {i: _storage(types[c]) for i, c in enumerate(columns)}
    at = lambda kind: F.col("position").isin([i for i, k in kinds.items() if k == kind])
    fixed = (F.when(at("whole"), F.col("a").cast("string")).when(at("flag"), (F.col("a") == 1).cast("string")).when(at("day"), F.date_from_unix_date(F.col("a").cast("int")).cast("string"))
             .when(at("double"), F.col("d").cast("string")).when(at("time"), F.col("t").cast("string")))
    out = _smallest(distinct_values(df, columns).select("position", fixed.alias("v")).where(~at("hash")))
    hashed = [i for i, kind in kinds.items() if kind == "hash"]
    if not hashed:
        return out
    none = F.lit(None).cast("struct<position:int,v:string>")
    met = _texts(df, columns).withColumn("__probes", probed)
    pairs = F.array(*[F.when(F.col(f"t{i}").isNotNull() & F.coalesce(F.col(f"t{i}") <= F.col("__probes")[i]["bound"], F.lit(True)),
                             F.struct(F.lit(i).alias("position"), F.col(f"t{i}").alias("v"))).otherwise(none) for i in hashed])
    # A plain generator and a null test afterwards: the array expression stays out of the filter.
    small = met.select(F.explode(pairs).alias("p")).where(F.col("p").isNotNull()).select("p.*").distinct()
    return out.unionByName(_smallest(small))


def profile(df: DataFrame, columns: Sequence[str] | None = None, max_unique_ratio: float = 0.1) -> DataFrame:
    """One row per column: PROFILE schema (see ``lintel.schemas``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (columns or df.columns) if not isinstance(types[c], T.BinaryType)]
    meta = column_frame(df, cols)
    # Both uses read the same one-row plan whole, so it runs once.
    one = probes(df, cols).scalar()
    stats = df.sparkSession.range(1).select(F.posexplode(one).alias("position", "f")).select("position", "f.*")
    joined = (F.broadcast(meta).join(stats, "position", "left").join(distinct_by_hash(df, cols), "position", "left")
              .join(samples(df, cols, one), "position", "left"))
    non_null = F.coalesce(F.col("non_null"), F.lit(0))
    total = F.coalesce(F.col("null_count"), F.lit(0)) + non_null
    num_ratio = F.when(F.col("typed_numeric"), F.lit(1.0)).otherwise(F.col("num_ok") / non_null)
    shape_ratio, parse_ratio = F.col("shape_ok") / non_null, F.col("date_ok") / non_null
    uniq_ratio = F.coalesce(F.col("unique_count"), F.lit(0)) / non_null
    name = F.lower(F.col("column"))
    date_hint = name.rlike(anchored(DATE_PATTERNS))
    is_date = (shape_ratio > 0.5) & (parse_ratio > 0.7)
    inferred = (F.when(non_null == 0, F.lit("unknown"))
                .when(num_ratio > 0.9, F.lit("numeric"))
                .when(is_date, F.lit("date"))
                .when(uniq_ratio < 0.1, F.lit("categorical"))
                .when(uniq_ratio > max(max_unique_ratio, 0.5), F.lit("id"))
                .otherwise(F.lit("text")))
    confidence = (F.when(non_null == 0, F.lit(0.5))
                  .when(num_ratio > 0.9, F.lit(0.95))
                  .when(is_date & date_hint, F.lit(0.95))
                  .when(is_date, F.lit(0.85))
                  .when(uniq_ratio < 0.1, F.lit(0.8))
                  .when(uniq_ratio > max(max_unique_ratio, 0.5), F.lit(0.7))
                  .otherwise(F.lit(0.6)))
    typed = joined.withColumn("inferred_type", inferred).withColumn("confidence", confidence)
    it = F.col("inferred_type")
    role = (F.when(name.rlike(anchored(ID_PATTERNS)), F.lit("id"))
            .when(date_hint, F.lit("date"))
            .when(name.rlike(anchored(MEASUREMENT_PATTERNS)), F.lit("measurement"))
            .when(it == "date", F.lit("date"))
            .when(it == "numeric", F.lit("measurement"))
            .when(it == "categorical", F.lit("dimension"))
            .otherwise(F.lit("other")))
    return typed.select(
        "column", "position", "physical_type", "inferred_type", "confidence",
        role.alias("semantic_role"),
        F.coalesce(F.col("null_count"), F.lit(0)).cast("long").alias("null_count"),
        F.coalesce(F.col("unique_count"), F.lit(0)).cast("long").alias("unique_count"),
        F.when(total > 0, F.col("null_count") / total).otherwise(F.lit(0.0)).alias("null_ratio"),
        F.coalesce(F.col("sample_values"), F.array().cast("array<string>")).alias("sample_values"),
    )


def profile_path(spark, path: str, fmt: str | None = None, preview_rows: int | None = None) -> DataFrame:
    """Profile a stored table: all rows of it, or a bounded preview (``operators.preview``) if ``preview_rows`` is given."""
    from lintel.operators.preview import KEY, bottom_k
    from lintel.sources.io import ensure_not_empty, read_table
    df = ensure_not_empty(read_table(spark, path, fmt), path)
    return profile(df if preview_rows is None else bottom_k(df, preview_rows).drop(KEY))


def profile_table(prof: DataFrame) -> DataFrame:
    """Display form: rounded confidence and null percentage, first three samples joined."""
    return prof.select(
        "column", F.col("inferred_type").alias("type"), F.col("semantic_role").alias("role"),
        F.round("confidence", 2).alias("confidence"), F.col("null_count").alias("nulls"),
        F.round(F.col("null_ratio") * 100, 2).alias("null_pct"), F.col("unique_count").alias("unique"),
        F.array_join(F.slice("sample_values", 1, 3), ", ").alias("sample"),
    )


def profile_type_counts(prof: DataFrame) -> DataFrame:
    return prof.groupBy(F.col("inferred_type").alias("type")).agg(F.count(F.lit(1)).alias("columns"))


def profile_summary(prof: DataFrame) -> DataFrame:
    """Long form (metric, key, value): totals, per type, per role and null-ratio figures."""
    one = prof.agg(
        F.count(F.lit(1)).cast("double").alias("total_columns"),
        F.count_if(F.col("null_count") > 0).cast("double").alias("columns_with_nulls"),
        F.count_if(F.col("null_ratio") > 0.5).cast("double").alias("columns_with_high_null"),
        F.round(F.coalesce(F.avg("null_ratio"), F.lit(0.0)), 6).alias("avg_null_ratio"),
    )
    scalars = one.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("key"), F.col(m).alias("value"))
        for m in ("total_columns", "columns_with_nulls", "columns_with_high_null", "avg_null_ratio")])))
    by_type = prof.groupBy("inferred_type").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("by_type").alias("metric"), F.col("inferred_type").alias("key"), "value")
    by_role = prof.groupBy("semantic_role").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("by_role").alias("metric"), F.col("semantic_role").alias("key"), "value")
    return scalars.unionByName(by_type).unionByName(by_role)
