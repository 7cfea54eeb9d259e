"""Sources and sinks: typed ingest, generic ingest, conformance, exports, read-back.

A headered CSV read with an explicit schema binds columns *by position*, so a
reordered file silently swaps columns.  Typed ingest here reads the header,
selects required columns *by name* and converts with ``try_cast``; values that
do not convert become null and are counted by ``schema_conformance``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lintel.operators.stats import colref
from lintel.schemas import RECORD_SCHEMA
from lintel.sources.inference import typed


class EmptyInputError(ValueError):
    pass


def read_table(spark: SparkSession, path: str, fmt: str | None = None, infer: bool = False, check_empty: bool = False) -> DataFrame:
    """Generic read: Parquet/ORC/JSON as stored; CSV with header as text.

    ``infer`` gives text columns the narrowest type that all their values have (``sources.inference``);
    ``check_empty`` raises on a table without rows, as the review does.
    """
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
    elif fmt in ("parquet", "orc", "json"):
        df = spark.read.format(fmt).load(path)
    else:
        df = spark.read.parquet(path)
    if check_empty:
        ensure_not_empty(df, path)
    return typed(df) if infer else df


def ensure_not_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise on an empty table; ``isEmpty`` reads at most one row, not the whole table."""
    if df.isEmpty():
        raise EmptyInputError(f"no records loaded from {what}")
    return df


def missing_columns(df: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> list[str]:
    return [f.name for f in schema.fields if f.name not in df.columns]


def conform(df: DataFrame, schema: T.StructType = RECORD_SCHEMA, strict: bool = True) -> DataFrame:
    """Select ``schema``'s columns by name and convert them; bad values become null.

    ``strict`` raises when a required column is absent; otherwise it is added as nulls.
    """
    absent = missing_columns(df, schema)
    if absent and strict:
        raise ValueError(f"missing required columns: {absent}")
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif types[f.name] == f.dataType:
            cols.append(colref(f.name))
        elif isinstance(types[f.name], T.StringType) and isinstance(f.dataType, T.DateType):
            cols.append(F.try_to_date(colref(f.name)).alias(f.name))
        else:
            cols.append(colref(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_records(spark: SparkSession, path: str, fmt: str | None = None,
                 schema: T.StructType = RECORD_SCHEMA, check_empty: bool = True) -> DataFrame:
    """Typed record read: text columns matched by header name, converted safely."""
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    raw = spark.read.option("header", True).csv(path) if fmt == "csv" else read_table(spark, path, fmt)
    df = conform(raw, schema)
    return ensure_not_empty(df, path) if check_empty else df


MALFORMED = "malformed line"
REASONS = "reject_reasons"
LINE = "__line"


@dataclass
class Split:
    """Rows tagged with why they are rejected (``reject_reasons``, empty for good rows), their raw texts and, for CSV, their line."""

    tagged: DataFrame
    schema: T.StructType

    def good(self) -> DataFrame:
        return self.tagged.where(F.size(REASONS) == 0).select(*[colref(f.name) for f in self.schema.fields])

    def bad(self) -> DataFrame:
        """``reject_reasons``, ``raw`` (the texts as a JSON object) and, for CSV, ``line``."""
        return self.tagged.where(F.size(REASONS) > 0).select(REASONS, "raw", "line")

    def counts(self) -> DataFrame:
        """Rows per reason; a row with two reasons counts under both, good rows under ``accepted``."""
        reasons = F.when(F.size(REASONS) == 0, F.array(F.lit("accepted"))).otherwise(F.col(REASONS))
        return self.tagged.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))

    def write(self, out_dir: str) -> None:
        """Both tables in one pass over the source: folders ``accepted=true`` and ``accepted=false``."""
        self.tagged.withColumn("accepted", F.size(REASONS) == 0).write.mode("overwrite").partitionBy("accepted").parquet(out_dir)


def split_rows(df: DataFrame, schema: T.StructType = RECORD_SCHEMA, line: str | None = None) -> Split:
    """Convert ``df`` to ``schema`` by name and tag the rows that do not fit.

    A row is rejected for every filled value that does not convert, for every required
    column that is null or missing though not nullable, and for a malformed line (``line`` names the
    column that holds it).  Good and bad rows together are all rows.
    """
    raw = [c for c in df.columns if c != line]
    types = {f.name: f.dataType for f in df.schema.fields}
    none, reasons, cols = F.array().cast("array<string>"), [], []
    broken = F.col(f"`{line}`").isNotNull() if line else F.lit(False)
    reasons.append(F.when(broken, F.array(F.lit(MALFORMED))).otherwise(none))
    for f in schema.fields:
        if f.name not in types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            if not f.nullable:
                reasons.append(F.array(F.lit(f"no column {f.name}")))
            continue
        src = colref(f.name)
        if types[f.name] == f.dataType:
            value = src
        elif isinstance(types[f.name], T.StringType) and isinstance(f.dataType, T.DateType):
            value = F.try_to_date(src)
        else:
            value = src.try_cast(f.dataType)
        cols.append(value.alias(f.name))
        # A broken line has shifted values, so only the line itself is the reason.
        reasons.append(F.when(~broken & src.isNotNull() & value.isNull(), F.array(F.lit(f"{f.name} is no {f.dataType.simpleString()}"))).otherwise(none))
        if not f.nullable:
            reasons.append(F.when(~broken & src.isNull(), F.array(F.lit(f"{f.name} is null"))).otherwise(none))
    text = F.to_json(F.struct(*[colref(c).alias(c) for c in raw]))
    return Split(df.select(*cols, F.concat(*reasons).alias(REASONS), text.alias("raw"), (F.col(f"`{line}`") if line else F.lit(None).cast("string")).alias("line")), schema)


def split_csv(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA) -> Split:
    """``split_rows`` of headered CSV files; lines with too few or too many fields keep their text in ``line``.

    Columns are bound by the header's names, whatever their order.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, LINE]])
    # Without pruning every line is parsed whole, so a ragged line shows whatever columns are asked for.
    raw = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).option("columnPruning", False).csv(path)
    return split_rows(raw, schema, LINE)


def schema_conformance(df: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Per required column: present?, non-null source values, values that fail conversion.

    One aggregate over the table, unpivoted into one row per required column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(schema.fields):
        if f.name not in types:
            continue
        src = colref(f.name)
        if types[f.name] == f.dataType:
            failed = F.lit(False)
        elif isinstance(types[f.name], T.StringType) and isinstance(f.dataType, T.DateType):
            failed = src.isNotNull() & F.try_to_date(src).isNull()
        else:
            failed = src.isNotNull() & src.try_cast(f.dataType).isNull()
        aggs += [F.count(src).alias(f"n{i}"), F.count_if(failed).alias(f"f{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, f in enumerate(schema.fields):
        present = f.name in types
        rows.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(types[f.name].simpleString() if present else None).alias("actual_type"),
            F.lit(present).alias("present"),
            (F.col(f"n{i}") if present else F.lit(0).cast("long")).alias("non_null"),
            (F.col(f"f{i}") if present else F.lit(0).cast("long")).alias("cast_failures"),
        ))
    return one.select(F.inline(F.array(*rows)))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Distributed write; CSV always carries a header so an empty result still reads back."""
    writer = df.write.mode(mode)
    writer.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).save(path)


# Values with quotes, line feeds or back-slashes survive a round trip; an empty text comes back as null, since CSV has one blank for both.
CSV_OPTIONS = {"header": True, "escape": '"', "multiLine": True}
MANIFEST_SCHEMA = "run_id string, published_at string, outputs array<struct<name:string,path:string,format:string,schema:string>>"


class Version:
    """The outputs of one run under ``<base>/versions/<run_id>``; ``publish`` makes them the valid ones."""

    def __init__(self, spark: SparkSession, base: str, run_id: str) -> None:
        self.spark, self.base, self.run_id = spark, base.rstrip("/"), run_id
        self.outputs: list[tuple[str, str, str, str]] = []

    def add(self, name: str, df: DataFrame, fmt: str) -> DataFrame:
        """Write one output and return it as read from there."""
        path = f"{self.base}/versions/{self.run_id}/{name}"
        df.write.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).mode("errorifexists").save(path)
        self.outputs.append((name, path, fmt, df.schema.json()))
        return _load(self.spark, path, fmt, df.schema)

    def publish(self, at: str) -> None:
        """Append the manifest row: one file, which appears whole when its job commits."""
        self.spark.createDataFrame([(self.run_id, at, self.outputs)], MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{self.base}/manifests")


def _load(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {}))
    return (reader.schema(schema) if schema is not None and fmt != "parquet" else reader).load(path)


def published(spark: SparkSession, base: str) -> dict[str, tuple[str, str, T.StructType]] | None:
    """Outputs of the newest published run by name: path, format, schema; None if nothing was published there."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).json(f"{base.rstrip('/')}/manifests")
        row = rows.orderBy(F.desc("published_at"), F.desc("run_id")).first()
    except AnalysisException:
        return None
    return None if row is None else {o["name"]: (o["path"], o["format"], T.StructType.fromJson(json.loads(o["schema"]))) for o in row["outputs"]}


def read_back(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Read an output: ``<base>/<name>`` of the newest published run of ``base`` if it has one, else the files at ``path``."""
    base, _, name = path.rstrip("/").rpartition("/")
    known = published(spark, base) if base else None
    if known and name in known:
        return _load(spark, *known[name])
    return _load(spark, path, fmt, schema)


def text_view(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns rendered as text (how a CSV source presents them)."""
    cols = columns or df.columns
    return df.select(*[colref(c).cast("string").alias(c) for c in cols])
