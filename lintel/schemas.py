"""Schemas of the tables the engine reads and produces."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType(), True),
    T.StructField("patient_id", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("field_name", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("expected_unit", T.StringType(), True),
    T.StructField("ref_low", T.DoubleType(), True),
    T.StructField("ref_high", T.DoubleType(), True),
    T.StructField("data_received_date", T.DateType(), True),
])

RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]

ISSUE_STRUCT = T.StructType([
    T.StructField("issue_type", T.StringType(), True),
    T.StructField("issue_column", T.StringType(), True),
    T.StructField("rule_id", T.StringType(), True),
    T.StructField("rule_severity", T.StringType(), True),
    T.StructField("metric_value", T.DoubleType(), True),
])

PROFILE_SCHEMA = T.StructType([
    T.StructField("column", T.StringType(), False),
    T.StructField("position", T.IntegerType(), False),
    T.StructField("physical_type", T.StringType(), True),
    T.StructField("inferred_type", T.StringType(), True),
    T.StructField("confidence", T.DoubleType(), True),
    T.StructField("semantic_role", T.StringType(), True),
    T.StructField("null_count", T.LongType(), True),
    T.StructField("unique_count", T.LongType(), True),
    T.StructField("null_ratio", T.DoubleType(), True),
    T.StructField("sample_values", T.ArrayType(T.StringType()), True),
])

DOMAIN_SCHEMA = "domain string, score long, matched array<string>"
