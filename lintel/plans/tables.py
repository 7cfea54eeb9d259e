"""Review inputs derived from the driver tables.

``records`` reshapes ``events`` into the clinical record layout (nulls,
unit mismatches and missing bounds are injected by id arithmetic);
``encounters`` joins ``lineitem`` to ``orders`` so each line has an
admission (order date) and a discharge (ship date).  Both are ordinary
Spark plans over the whole tables, so their work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Review parameters used with the derived record table.
RECORDS_REVIEW_DATE = "2024-01-31"
RECORDS_STALE_DAYS = 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    day = F.col("ts").cast("date")
    return ev.select(
        F.concat(F.lit("E-"), eid.cast("string")).alias("record_id"),
        F.concat(F.lit("P-"), uid.cast("string")).alias("patient_id"),
        F.when(uid % 3 == 0, "Lab").when(uid % 3 == 1, "EDC").otherwise("AE").alias("source"),
        F.concat(F.col("event_type"), F.lit("@"), day.cast("string")).alias("field_name"),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(F.col("value")).cast("double").alias("value"),
        F.when(eid % 29 == 0, "g/L").otherwise("g/dL").alias("unit"),
        F.when(eid % 31 == 0, F.lit(None)).otherwise(F.lit("g/dL")).alias("expected_unit"),
        F.when(eid % 37 == 0, F.lit(None)).otherwise(F.lit(5.0)).cast("double").alias("ref_low"),
        F.when(eid % 41 == 0, F.lit(None)).otherwise(F.lit(100.0)).cast("double").alias("ref_high"),
        day.alias("data_received_date"),
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"]).select(
        F.concat(F.lit("L-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("encounter_ref"),
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("o_orderdate").alias("admission_date"),
        F.col("l_shipdate").alias("discharge_date"),
        F.col("o_orderstatus").alias("status"),
    )


# DuckDB text of the same derivations, for oracle queries.
RECORDS_SQL = """rec AS (
  SELECT concat('E-', CAST(event_id AS VARCHAR)) AS record_id,
         concat('P-', CAST(user_id AS VARCHAR)) AS patient_id,
         CASE WHEN user_id % 3 = 0 THEN 'Lab' WHEN user_id % 3 = 1 THEN 'EDC' ELSE 'AE' END AS source,
         concat(event_type, '@', CAST(CAST(ts AS DATE) AS VARCHAR)) AS field_name,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 29 = 0 THEN 'g/L' ELSE 'g/dL' END AS unit,
         CASE WHEN event_id % 31 = 0 THEN NULL ELSE 'g/dL' END AS expected_unit,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE 5.0::DOUBLE END AS ref_low,
         CASE WHEN event_id % 41 = 0 THEN NULL ELSE 100.0::DOUBLE END AS ref_high,
         CAST(ts AS DATE) AS data_received_date
  FROM events
)"""

ENCOUNTERS_SQL = """enc AS (
  SELECT concat('L-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS encounter_ref,
         l_orderkey, l_linenumber, o_orderdate AS admission_date, l_shipdate AS discharge_date,
         o_orderstatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def records_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record table as a text source would present it: strings, columns in another
    order, ``ref_high`` absent, some values that do not convert."""
    rec = records(spark, sf_dir)
    base = rec.withColumn("__eid", F.regexp_extract("record_id", r"^E-(\d+)$", 1).cast("long"))
    text = base.select(
        "__eid",
        F.when(F.col("__eid") % 59 == 0, F.lit("not-a-date"))
         .otherwise(F.col("data_received_date").cast("string")).alias("data_received_date"),
        F.col("ref_low").cast("string").alias("ref_low"),
        F.col("expected_unit"), F.col("unit"),
        F.when(F.col("__eid") % 53 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        "field_name", "source", "patient_id", "record_id",
    )
    return text.drop("__eid")


def clinical_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounter-shaped rows from lineitem x orders, exercising every clinical-pack rule."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(ok % 101 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("EN-"), ok.cast("string"), F.lit("-"), ln.cast("string"))).alias("encounter_id"),
        F.col("o_orderdate").alias("admission_date"),
        F.col("l_shipdate").alias("discharge_date"),
        F.when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "F", "Closed")
         .otherwise("partial").alias("status"),
        F.when(ln == 1, "M").when(ln == 2, "F").when(ln == 3, "female").when(ln == 4, "X").alias("gender"),
        F.concat(F.chr((F.lit(65) + pk % 26).cast("long")), (pk % 10).cast("string"),
                 (F.floor(pk / 10) % 10).cast("string"),
                 F.when(pk % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("."), (pk % 7).cast("string"))))
         .alias("icd_code"),
        F.when(sk % 9 == 0, sk.cast("string")).otherwise(F.lpad((sk * 7919).cast("string"), 10, "0")).alias("npi"),
        (F.col("l_quantity") * 3 - 10).cast("int").alias("age"),
        (F.col("l_discount") * 1000).alias("bmi"),
        (F.col("l_extendedprice") / 300).alias("heart_rate"),
        (F.col("l_tax") * 4000).alias("systolic"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) - 5000).alias("paid_amount"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return od.select(
        "o_orderkey",
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("T-"), k.cast("string"))).alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        F.when(k % 89 == 0, F.lit(None)).when(k % 50 == 0, -F.col("o_totalprice"))
         .otherwise(F.col("o_totalprice")).alias("amount"),
        F.col("o_orderdate").alias("posted_date"),
        F.col("o_orderstatus").alias("status"),
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    pt = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return pt.select(
        "p_partkey",
        F.when(k % 101 == 0, F.lit(None)).otherwise(F.concat(F.lit("SKU-"), k.cast("string"))).alias("sku"),
        F.when(k % 61 == 0, F.lit(None)).otherwise(F.col("p_size") - 5).alias("quantity"),
        F.date_add(F.lit("1996-01-01").cast("date"), (k % 1500).cast("int")).alias("updated"),
        F.col("p_type").alias("category"),
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    uid = F.when(e % 7 == 0, F.lit(None)).otherwise(F.col("user_id"))
    return ev.select(
        "event_id",
        F.concat(F.lit("S-"), uid.cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("session_id"),
        uid.alias("user_id"),
        F.when(e % 43 == 0, F.lit(None)).otherwise(F.col("ts")).alias("event_timestamp"),
        (F.col("value") * 1000).alias("duration"),
        (F.col("value") - 5).alias("value"),
    )


def customers_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    return cu.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, F.lit(None))
                         .otherwise(F.col("c_mktsegment")))
