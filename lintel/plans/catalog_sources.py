"""Registered queries: type inference, rejected rows, kept sketches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.operators import sketches
from lintel.operators.date_formats import date_formats, shapes
from lintel.operators.stats import distinct_counts
from lintel.plans import tables
from lintel.plans.catalog import register
from lintel.plans.engine import RuleEngine
from lintel.sources import inference, io

# ---------------------------------------------------------------- type inference
# Columns of every kind, with blanks, and with one kind of value that widens a column.
TEXTS_SQL = """texts AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(ts AS VARCHAR) AS moment, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
         CASE WHEN event_id % 5 = 0 THEN ' ' WHEN user_id % 2 = 0 THEN 'TRUE' ELSE 'false' END AS flag,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS who,
         CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) ELSE CAST(CAST(user_id AS DECIMAL(18, 2)) AS VARCHAR) END AS amount,
         CASE WHEN user_id % 97 = 5 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS dirty,
         CASE WHEN event_id % 2 = 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) ELSE CAST(ts AS VARCHAR) END AS mixed_time,
         CASE WHEN event_id % 11 = 0 THEN '2024-02-30' ELSE '2024-02-28' END AS no_day,
         CAST(NULL AS VARCHAR) AS nothing, event_type AS kind
  FROM events)"""


def texts(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events")
    e, u, ts, day = F.col("event_id"), F.col("user_id"), F.col("ts").cast("string"), F.col("ts").cast("date").cast("string")
    return ev.select(
        e.cast("string").alias("id"), ts.alias("moment"), day.alias("day"),
        F.when(e % 5 == 0, " ").when(u % 2 == 0, "TRUE").otherwise("false").alias("flag"),
        F.when(e % 7 != 0, u.cast("string")).alias("who"),
        F.when(e % 3 == 0, u.cast("string")).otherwise(u.cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(u % 97 == 5, "n/a").otherwise(u.cast("string")).alias("dirty"),
        F.when(e % 2 == 0, day).otherwise(ts).alias("mixed_time"),
        F.when(e % 11 == 0, "2024-02-30").otherwise("2024-02-28").alias("no_day"),
        F.lit(None).cast("string").alias("nothing"), F.col("event_type").alias("kind"))


_TEXT_COLUMNS = ("id", "moment", "day", "flag", "who", "amount", "dirty", "mixed_time", "no_day", "nothing", "kind")


def _infer_sql(i: int, c: str) -> str:
    t = f"trim({c})"
    none = f"coalesce(count_if({t} <> ''), 0)"
    every = lambda test: f"count_if({t} <> '' AND NOT ({test})) = 0"
    date = f"regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') AND TRY_CAST({t} AS DATE) IS NOT NULL"
    stamp = f"regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}[ T][0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]{{1,6}})?)?') AND TRY_CAST({t} AS TIMESTAMP) IS NOT NULL"
    number = f"regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
    return f"""SELECT '{c}' AS "column", {i} AS position, CASE WHEN {none} = 0 THEN 'string'
  WHEN {every(f"lower({t}) IN ('true', 'false')")} THEN 'boolean' WHEN {every(f"regexp_full_match({t}, '[+-]?[0-9]{{1,18}}')")} THEN 'bigint'
  WHEN {every(number)} THEN 'double' WHEN {every(date)} THEN 'date' WHEN {every(f"({date}) OR ({stamp})")} THEN 'timestamp' ELSE 'string' END AS inferred_type,
  {none} AS filled FROM texts"""


@register("infer_types", "WITH " + TEXTS_SQL + "\n" + "\nUNION ALL ".join(_infer_sql(i, c) for i, c in enumerate(_TEXT_COLUMNS)))
def q_infer_types(spark, sf_dir):
    return inference.infer_types(texts(spark, sf_dir)).drop("bits")


@register("infer_types_customer", "WITH texts AS (SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
          "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer)\n"
          + "\nUNION ALL ".join(_infer_sql(i, c) for i, c in enumerate(("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))))
def q_infer_types_customer(spark, sf_dir):
    return inference.infer_types(io.text_view(tables.table(spark, sf_dir, "customer"))).drop("bits")


# ---------------------------------------------------------------- date formats
DATED_SQL = """dated AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%d.%m.%Y') AS dotted, strftime(o_orderdate, '%m/%d/%Y') AS slashed,
         CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS unsure,
         CASE WHEN o_orderkey % 3 = 0 THEN 'open' ELSE strftime(o_orderdate, '%Y/%m/%d 10:30') END AS timed,
         strftime(o_orderdate, '03/%m/%Y') AS early, o_orderpriority AS priority, CASE WHEN o_orderkey % 5 < 3 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS few
  FROM orders)"""


def dated(spark, sf_dir):
    o = tables.table(spark, sf_dir, "orders")
    k, day = F.col("o_orderkey"), lambda f: F.date_format("o_orderdate", f)
    return o.select(day("yyyy-MM-dd").alias("iso"), day("dd.MM.yyyy").alias("dotted"), day("MM/dd/yyyy").alias("slashed"),
                    F.when(k % 4 == 0, day("MM/dd/yyyy")).otherwise(day("dd/MM/yyyy")).alias("unsure"),
                    F.when(k % 3 == 0, "open").otherwise(day("yyyy/MM/dd '10:30'")).alias("timed"),
                    day("'03'/MM/yyyy").alias("early"), F.col("o_orderpriority").alias("priority"),
                    F.when(k % 5 < 3, "n/a").otherwise(day("yyyy-MM-dd")).alias("few"))


def _format_sql(column: str, fmt: str | None, order: str | None, shape: str) -> str:
    text = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"
    return (f"""SELECT '{column}' AS "column", {text(fmt)} AS date_format, {text(order)} AS field_order, """
            f"round(count_if(regexp_full_match({column}, '{shape}')) / count(*), 6) AS share, count(*) AS values FROM dated")


_YMD, _DMY = "[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}.*", "[0-9]{2}[./][0-9]{2}[./][0-9]{4}"


@register("date_formats", "WITH " + DATED_SQL + "\n" + "\nUNION ALL ".join([
    _format_sql("iso", "yyyy-M-d", "known", _YMD), _format_sql("dotted", "d.M.yyyy", "known", _DMY), _format_sql("slashed", "M/d/yyyy", "known", _DMY),
    _format_sql("unsure", "d/M/yyyy", "mixed", _DMY), _format_sql("timed", "yyyy/M/d H:mm", "known", _YMD), _format_sql("early", "M/d/yyyy", "assumed", _DMY),
    _format_sql("priority", None, None, _YMD), _format_sql("few", None, None, _YMD)]))
def q_date_formats(spark, sf_dir):
    return date_formats(dated(spark, sf_dir))


@register("date_masks", "WITH " + DATED_SQL + """
SELECT 'timed' AS "column", regexp_replace(regexp_replace(timed, '[0-9]', '9', 'g'), '[a-z]+', 'a', 'g') AS mask, count(*) AS values,
  coalesce(count_if(try_cast(substr(timed, 6, 2) AS INTEGER) > 12), 0) AS first_high, coalesce(count_if(try_cast(substr(timed, 9, 2) AS INTEGER) > 12), 0) AS second_high FROM dated GROUP BY 2""")
def q_date_masks(spark, sf_dir):
    return shapes(dated(spark, sf_dir), ["timed"])


# ---------------------------------------------------------------- rejected rows
ORDER_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.LongType(), False),
                             T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.DateType())])
DIRTY_ORDERS_SQL = """dirty AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
         CASE WHEN o_orderkey % 17 = 0 THEN 'unknown' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
         CASE WHEN o_orderkey % 19 = 0 THEN '31.12.' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS o_orderdate
  FROM orders)"""


def dirty_orders(spark, sf_dir):
    k = F.col("o_orderkey")
    return tables.table(spark, sf_dir, "orders").select(
        F.when(k % 19 == 0, "31.12.").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("o_orderdate"),
        F.when(k % 17 == 0, "unknown").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        k.cast("string").alias("o_orderkey"), F.when(k % 13 != 0, F.col("o_custkey").cast("string")).alias("o_custkey"))


@register("rejected_rows", "WITH " + DIRTY_ORDERS_SQL + """,
why AS (SELECT o_orderkey, list_filter([CASE WHEN o_custkey IS NULL THEN 'o_custkey is null' END,
  CASE WHEN o_totalprice = 'unknown' THEN 'o_totalprice is no double' END, CASE WHEN o_orderdate = '31.12.' THEN 'o_orderdate is no date' END], lambda x: x IS NOT NULL) AS r FROM dirty)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, array_to_string(r, '; ') AS reasons FROM why WHERE len(r) > 0""")
def q_rejected_rows(spark, sf_dir):
    bad = io.split_rows(dirty_orders(spark, sf_dir), ORDER_SCHEMA).bad()
    return bad.select(F.get_json_object("raw", "$.o_orderkey").cast("long").alias("o_orderkey"), F.array_join(io.REASONS, "; ").alias("reasons"))


@register("accepted_rows", "WITH " + DIRTY_ORDERS_SQL + """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM dirty WHERE o_custkey IS NOT NULL AND o_totalprice <> 'unknown' AND o_orderdate <> '31.12.'""")
def q_accepted_rows(spark, sf_dir):
    return io.split_rows(dirty_orders(spark, sf_dir), ORDER_SCHEMA).good()


@register("reject_counts", "WITH " + DIRTY_ORDERS_SQL + """
SELECT reason, rows FROM (
  SELECT 'accepted' AS reason, count_if(o_custkey IS NOT NULL AND o_totalprice <> 'unknown' AND o_orderdate <> '31.12.') AS rows FROM dirty
  UNION ALL SELECT 'o_custkey is null', count_if(o_custkey IS NULL) FROM dirty
  UNION ALL SELECT 'o_totalprice is no double', count_if(o_totalprice = 'unknown') FROM dirty
  UNION ALL SELECT 'o_orderdate is no date', count_if(o_orderdate = '31.12.') FROM dirty) WHERE rows > 0""")
def q_reject_counts(spark, sf_dir):
    return io.split_rows(dirty_orders(spark, sf_dir), ORDER_SCHEMA).counts()


# ---------------------------------------------------------------- kept sketches
SKETCHED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate")


def line_sketches(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    return sketches.column_sketches(li, F.date_format("l_shipdate", "yyyy-MM"), SKETCHED)


@register("sketch_merge", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS null_count, COUNT({c}) AS non_null, COUNT(DISTINCT {c}) AS unique_count, TRUE AS near_whole, TRUE AS within_bound FROM lineitem"""
    for c in SKETCHED))
def q_sketch_merge(spark, sf_dir):
    """Sketches per ship month, merged, against one sketch of the whole table and against exact counts (five standard errors each).

    Registers of the merged sketch are those of the whole; the estimators differ, since a sketch that
    saw all rows itself also uses the order of its updates.
    """
    li = tables.table(spark, sf_dir, "lineitem")
    parts = sketches.estimates(line_sketches(spark, sf_dir))
    whole = sketches.estimates(sketches.column_sketches(li, F.lit("all"), SKETCHED)).select("column", F.col("unique_estimate").alias("whole"))
    exact = distinct_counts(li, SKETCHED).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n")) for i, c in enumerate(SKETCHED)])))
    found = parts.join(whole, "column").join(exact, "column")
    n = F.col("n") - (F.col("null_count") > 0).cast("long")
    bound = F.ceil(5 * sketches.STANDARD_ERROR * n)
    return found.select("column", "null_count", "non_null", n.alias("unique_count"), (F.abs(F.col("unique_estimate") - F.col("whole")) <= 2 * bound).alias("near_whole"),
                        (F.abs(F.col("unique_estimate") - n) <= bound).alias("within_bound"))


@register("cardinality_from_sketches", "SELECT l_orderkey, l_linenumber, l_partkey, 'high_cardinality_l_partkey' AS issue_type, 'many_parts' AS rule_id "
          "FROM lineitem WHERE (SELECT COUNT(DISTINCT l_partkey) FROM lineitem) > 50")
def q_cardinality_from_sketches(spark, sf_dir):
    """The cardinality rule reads kept sketches instead of the table."""
    rules = [{"id": "many_parts", "type": "cardinality", "column_pattern": "^l_(partkey|returnflag)$", "max_unique": 50}]
    found = RuleEngine(rules, distinct_state=line_sketches(spark, sf_dir)).issues(tables.table(spark, sf_dir, "lineitem"))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "issue_type", "rule_id")
