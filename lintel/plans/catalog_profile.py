"""Registered queries: column profile, domain classification, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lintel.operators import domain as D, preview as V, profile as P, recommend as R
from lintel.plans import tables
from lintel.plans.catalog import register
from lintel.plans.tables import RECORDS_SQL

# Column metadata of the profiled tables for the oracle: (name, typed numeric).
REC_COLS = [("record_id", False), ("patient_id", False), ("source", False), ("field_name", False),
            ("value", True), ("unit", False), ("expected_unit", False), ("ref_low", True), ("ref_high", True),
            ("data_received_date", False)]
CUSTOMER_COLS = [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True),
                 ("c_mktsegment", False)]

# The name patterns of roles, written out apart from the engine's.
ID_RE = r"^(?:.*id$|^id_.*|.*_id$|.*record.*id|.*patient.*id|.*user.*id|.*customer.*id|.*account.*id|.*code$)"
DATE_RE = r"^(?:.*date$|^date_.*|.*_date$|.*timestamp|.*time$|.*created|.*modified|.*received)"
MEAS_RE = (r"^(?:.*amount$|.*price$|.*value$|.*count$|.*rate$|.*percentage$|.*score$|.*ref_.*|.*_low$|.*_high$"
           r"|.*reference)")
NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SHAPE_RE = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}"


def profile_sql(source_cte: str, table: str, cols: list[tuple[str, bool]]) -> str:
    """DuckDB text of the whole-table profile (PROFILE rows, one per column)."""
    vals = "\n  UNION ALL ".join(f"SELECT {i} AS position, CAST({c} AS VARCHAR) AS v FROM {table}"
                                 for i, (c, _) in enumerate(cols))
    meta = ", ".join(f"({i}, '{c}', {str(t).upper()})" for i, (c, t) in enumerate(cols))
    return f"""WITH {source_cte + "," if source_cte else ""}
vals AS (
  {vals}
),
pv AS (
  SELECT position, v, COUNT(*) AS cnt,
         coalesce(regexp_full_match(v, '{NUM_RE}') AND TRY_CAST(v AS DOUBLE) IS NOT NULL, FALSE) AS is_num,
         coalesce(regexp_matches(v, '{SHAPE_RE}'), FALSE) AS has_shape,
         coalesce(TRY_CAST(v AS DATE) IS NOT NULL OR try_strptime(v, '%Y/%m/%d') IS NOT NULL
                  OR try_strptime(v, '%m/%d/%Y') IS NOT NULL, FALSE) AS parses
  FROM vals GROUP BY position, v
),
meta(position, "column", typed_numeric) AS (VALUES {meta}),
st AS (
  SELECT position,
         coalesce(sum(cnt) FILTER (WHERE v IS NULL), 0) AS null_count,
         coalesce(sum(cnt) FILTER (WHERE v IS NOT NULL), 0) AS non_null,
         COUNT(v) AS unique_count,
         coalesce(sum(cnt) FILTER (WHERE v IS NOT NULL AND is_num), 0) AS num_ok,
         coalesce(sum(cnt) FILTER (WHERE v IS NOT NULL AND has_shape), 0) AS shape_ok,
         coalesce(sum(cnt) FILTER (WHERE v IS NOT NULL AND parses), 0) AS date_ok
  FROM pv GROUP BY position
),
smp AS (
  SELECT position, list(v ORDER BY v) AS sample_values FROM (
    SELECT position, v, row_number() OVER (PARTITION BY position ORDER BY v) AS rn FROM pv WHERE v IS NOT NULL
  ) WHERE rn <= 5 GROUP BY position
),
j AS (
  SELECT m.position, m."column", m.typed_numeric, st.null_count, st.non_null, st.unique_count,
         CASE WHEN m.typed_numeric THEN 1.0 ELSE st.num_ok / st.non_null END AS num_ratio,
         st.shape_ok / st.non_null AS shape_ratio, st.date_ok / st.non_null AS parse_ratio,
         st.unique_count / st.non_null AS uniq_ratio,
         regexp_matches(lower(m."column"), '{DATE_RE}') AS date_hint, smp.sample_values
  FROM meta m LEFT JOIN st USING (position) LEFT JOIN smp USING (position)
),
t AS (
  SELECT *,
    CASE WHEN non_null = 0 THEN 'unknown' WHEN num_ratio > 0.9 THEN 'numeric'
         WHEN shape_ratio > 0.5 AND parse_ratio > 0.7 THEN 'date'
         WHEN uniq_ratio < 0.1 THEN 'categorical' WHEN uniq_ratio > 0.5 THEN 'id' ELSE 'text' END AS inferred_type,
    CASE WHEN non_null = 0 THEN 0.5e0 WHEN num_ratio > 0.9 THEN 0.95e0
         WHEN shape_ratio > 0.5 AND parse_ratio > 0.7 AND date_hint THEN 0.95e0
         WHEN shape_ratio > 0.5 AND parse_ratio > 0.7 THEN 0.85e0
         WHEN uniq_ratio < 0.1 THEN 0.8e0 WHEN uniq_ratio > 0.5 THEN 0.7e0 ELSE 0.6e0 END AS confidence
  FROM j
),
prof AS (
  SELECT "column", position, inferred_type, confidence,
    CASE WHEN regexp_matches(lower("column"), '{ID_RE}') THEN 'id'
         WHEN date_hint THEN 'date'
         WHEN regexp_matches(lower("column"), '{MEAS_RE}') THEN 'measurement'
         WHEN inferred_type = 'date' THEN 'date' WHEN inferred_type = 'numeric' THEN 'measurement'
         WHEN inferred_type = 'categorical' THEN 'dimension' ELSE 'other' END AS semantic_role,
    CAST(null_count AS BIGINT) AS null_count, CAST(unique_count AS BIGINT) AS unique_count,
    CASE WHEN null_count + non_null > 0 THEN null_count / (null_count + non_null) ELSE 0.0 END AS null_ratio,
    coalesce(sample_values, []) AS sample_values
  FROM t
)
"""


REC_PROFILE = profile_sql(RECORDS_SQL, "rec", REC_COLS)
CUSTOMER_PROFILE = profile_sql("", "customer", CUSTOMER_COLS)


def _rec_profile(spark, sf_dir):
    return P.profile(tables.records(spark, sf_dir))


@register("profile_nulls", REC_PROFILE + 'SELECT "column", null_count, round(null_ratio, 6) AS null_ratio FROM prof')
def q_profile_nulls(spark, sf_dir):
    return _rec_profile(spark, sf_dir).select("column", "null_count", F.round("null_ratio", 6).alias("null_ratio"))


@register("profile_unique", REC_PROFILE + 'SELECT "column", unique_count FROM prof')
def q_profile_unique(spark, sf_dir):
    return _rec_profile(spark, sf_dir).select("column", "unique_count")


@register("profile_types", REC_PROFILE + 'SELECT "column", inferred_type, confidence FROM prof')
def q_profile_types(spark, sf_dir):
    return _rec_profile(spark, sf_dir).select("column", "inferred_type", "confidence")


@register("profile_roles", REC_PROFILE + 'SELECT "column", semantic_role FROM prof')
def q_profile_roles(spark, sf_dir):
    return _rec_profile(spark, sf_dir).select("column", "semantic_role")


@register("profile_samples", REC_PROFILE + """SELECT "column", array_to_string(sample_values, ' | ') AS sample_values FROM prof""")
def q_profile_samples(spark, sf_dir):
    # Arrays are rendered as text so both engines hash the same value.
    return _rec_profile(spark, sf_dir).select("column", F.array_join("sample_values", " | ").alias("sample_values"))


PROFILE_TABLE_SQL = ('SELECT "column", inferred_type AS type, semantic_role AS role, round(confidence, 2) AS confidence, '
                     'null_count AS nulls, round(null_ratio * 100, 2) AS null_pct, unique_count AS "unique", '
                     "array_to_string(sample_values[1:3], ', ') AS sample FROM prof")


@register("profile_table", REC_PROFILE + PROFILE_TABLE_SQL)
def q_profile_table(spark, sf_dir):
    return P.profile_table(_rec_profile(spark, sf_dir))


@register("profile_table_customer", CUSTOMER_PROFILE + PROFILE_TABLE_SQL)
def q_profile_table_customer(spark, sf_dir):
    return P.profile_table(P.profile(tables.table(spark, sf_dir, "customer")))


@register("profile_type_counts", REC_PROFILE + "SELECT inferred_type AS type, COUNT(*) AS columns FROM prof GROUP BY 1")
def q_profile_type_counts(spark, sf_dir):
    return P.profile_type_counts(_rec_profile(spark, sf_dir))


@register("profile_summary", REC_PROFILE + """
SELECT 'total_columns' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(COUNT(*) AS DOUBLE) AS value FROM prof
UNION ALL SELECT 'columns_with_nulls', NULL, CAST(count_if(null_count > 0) AS DOUBLE) FROM prof
UNION ALL SELECT 'columns_with_high_null', NULL, CAST(count_if(null_ratio > 0.5) AS DOUBLE) FROM prof
UNION ALL SELECT 'avg_null_ratio', NULL, round(coalesce(avg(null_ratio), 0.0), 6) FROM prof
UNION ALL SELECT 'by_type', inferred_type, CAST(COUNT(*) AS DOUBLE) FROM prof GROUP BY inferred_type
UNION ALL SELECT 'by_role', semantic_role, CAST(COUNT(*) AS DOUBLE) FROM prof GROUP BY semantic_role""")
def q_profile_summary(spark, sf_dir):
    return P.profile_summary(_rec_profile(spark, sf_dir))


DOC_COLS = [("doc_id", True), ("text", False), ("lang", False), ("source", False), ("n_chars", True)]
PAGE_COLS = [("page_id", True), ("url", False), ("html", False)]


@register("profile_documents", profile_sql("", "documents", DOC_COLS) + PROFILE_TABLE_SQL)
def q_profile_documents(spark, sf_dir):
    return P.profile_table(P.profile(tables.table(spark, sf_dir, "documents")))


@register("profile_pages", profile_sql("", "pages", PAGE_COLS) + PROFILE_TABLE_SQL)
def q_profile_pages(spark, sf_dir):
    return P.profile_table(P.profile(tables.table(spark, sf_dir, "pages")))


@register("physical_types", """SELECT * FROM (VALUES ('event_id', 0, 'bigint', 'numeric'), ('ts', 1, 'timestamp_ntz', 'date'),
  ('user_id', 2, 'bigint', 'numeric'), ('event_type', 3, 'string', 'categorical'), ('value', 4, 'double', 'numeric'),
  ('props', 5, 'string', (SELECT CASE WHEN count(DISTINCT props) / count(props) < 0.1 THEN 'categorical'
     WHEN count(DISTINCT props) / count(props) > 0.5 THEN 'id' ELSE 'text' END FROM events))) t("column", position, physical_type, inferred_type)""")
def q_physical_types(spark, sf_dir):
    return P.profile(tables.table(spark, sf_dir, "events")).select("column", "position", "physical_type", "inferred_type")


# ---------------------------------------------------------------- preview
# The same key in DuckDB: "-" for null, else byte count, colon and value, column after column.
PREVIEW_KEY_SQL = "md5(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
                                       for c, _ in DOC_COLS) + ")"


@register("preview_documents", f"""SELECT doc_id, text, lang, source, n_chars, round(least(1.0, 200.0 / (SELECT count(*) FROM documents)), 9) AS preview_fraction
FROM documents ORDER BY {PREVIEW_KEY_SQL} LIMIT 200""")
def q_preview_documents(spark, sf_dir):
    return V.preview(tables.table(spark, sf_dir, "documents"), 200).withColumn(V.FRACTION, F.round(V.FRACTION, 9))


@register("preview_row_estimate", """SELECT TRUE AS within_bound, count(*) AS rows FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)""")
def q_preview_row_estimate(spark, sf_dir):
    # Six standard errors of a sketch of 400 keys.
    conv = tables.table(spark, sf_dir, "conversations")
    guess = V.estimated_rows(V.bottom_k(conv, 400), 400).scalar()
    rows = conv.distinct().agg(F.count(F.lit(1)).alias("rows"))
    return rows.select((F.abs(guess - F.col("rows")) <= 6 * F.col("rows") / F.sqrt(F.lit(398.0))).alias("within_bound"), "rows")


# ---------------------------------------------------------------- domain
# Fixed values, written out here so that a wrong keyword in the engine shows.
KEYWORDS_SQL = """lists(domain, domain_order, keywords) AS (VALUES
  ('clinical', 0, ['patient', 'record', 'encounter', 'visit', 'diagnosis', 'icd', 'procedure', 'medication', 'rx', 'lab',
    'result', 'value', 'unit', 'ref_low', 'ref_high', 'vital', 'blood_pressure', 'heart_rate', 'glucose', 'hemoglobin',
    'admission', 'discharge', 'provider', 'claim', 'member']),
  ('financial', 1, ['transaction', 'amount', 'balance', 'invoice', 'payment', 'account', 'debit', 'credit', 'price',
    'currency', 'ledger', 'refund']),
  ('inventory', 2, ['sku', 'product', 'item', 'warehouse', 'stock', 'quantity', 'reorder', 'supplier', 'location',
    'shipment']),
  ('web_analytics', 3, ['event', 'session', 'user', 'page', 'click', 'timestamp', 'duration', 'browser', 'device',
    'campaign', 'utm'])),
kw AS (SELECT domain, domain_order, unnest(keywords) AS keyword FROM lists)"""


def domain_sql(source_cte: str, table: str, cols: list[tuple[str, bool]]) -> str:
    names = ", ".join(f"('{c.lower().replace('-', '_')}')" for c, _ in cols)
    spaced = "concat(' ', trim(regexp_replace(lower(CAST({} AS VARCHAR)), '[^a-z0-9]+', ' ', 'g')), ' ')"
    texts = " UNION ALL ".join(f"""SELECT '{c}' AS "column", {spaced.format(c)} AS t FROM {table} WHERE {c} IS NOT NULL""" for c, wordy in cols if wordy)
    return f"""WITH {source_cte + "," if source_cte else ""}
{KEYWORDS_SQL},
names(n) AS (VALUES {names}),
texts AS ({texts}),
sizes AS (SELECT "column", COUNT(*) AS filled, sum(length(t) - length(replace(t, ' ', '')) - 1) AS words FROM texts GROUP BY 1),
held AS (SELECT t."column", k.keyword, COUNT(*) AS hits FROM texts t JOIN (SELECT DISTINCT keyword FROM kw) k ON contains(t.t, concat(' ', replace(k.keyword, '_', ' '), ' ')) GROUP BY ALL),
spoken AS (SELECT DISTINCT keyword FROM held JOIN sizes USING ("column") WHERE hits / filled * least(1.0e0, 8.0e0 * filled / greatest(words, 1)) >= 0.2e0),
hits AS (
  SELECT domain, domain_order, keyword,
    CASE WHEN EXISTS (SELECT 1 FROM names WHERE contains(n, keyword)) THEN 2
         WHEN keyword IN (SELECT keyword FROM spoken) THEN 1 ELSE 0 END AS points
  FROM kw
),
scores AS (
  SELECT domain, domain_order, CAST(sum(points) AS BIGINT) AS score,
         coalesce(list(keyword ORDER BY keyword) FILTER (WHERE points > 0), []) AS matched
  FROM hits GROUP BY domain, domain_order
)
"""


# (column, whether its values are words)
REC_WORDS = [("record_id", True), ("patient_id", True), ("source", True), ("field_name", True), ("value", False), ("unit", True), ("expected_unit", True),
             ("ref_low", False), ("ref_high", False), ("data_received_date", False)]
EVENT_WORDS = [("event_id", False), ("ts", False), ("user_id", False), ("event_type", True), ("value", False), ("props", True)]
DOC_WORDS = [("doc_id", False), ("text", True), ("lang", True), ("source", True), ("n_chars", False)]
TALK_WORDS = [("conv_id", False), ("turn", False), ("role", True), ("text", True)]
PAGE_WORDS = [("page_id", False), ("url", True), ("html", True)]
REC_DOMAIN = domain_sql(RECORDS_SQL, "rec", REC_WORDS)


@register("domain_scores", REC_DOMAIN +
          "SELECT domain, score, array_to_string(matched, ' | ') AS matched FROM scores")
def q_domain_scores(spark, sf_dir):
    sc = D.domain_scores(tables.records(spark, sf_dir))
    return sc.select("domain", "score", F.array_join("matched", " | ").alias("matched"))


@register("domain_score_table", REC_DOMAIN +
          "SELECT domain, score, array_to_string(matched, ', ') AS matched_signals FROM scores")
def q_domain_score_table(spark, sf_dir):
    return D.domain_score_table(D.domain_scores(tables.records(spark, sf_dir)))


BEST_SQL = """SELECT CASE WHEN score = 0 THEN 'generic' ELSE domain END AS domain,
       CASE WHEN score = 0 THEN 0.25 ELSE round(score / (SELECT sum(score) FROM scores), 2) END AS confidence,
       CASE WHEN score = 0 THEN '' ELSE array_to_string(matched, ' | ') END AS reason
FROM scores ORDER BY score DESC, domain_order LIMIT 1"""


@register("domain_best", domain_sql("", "events", EVENT_WORDS) + BEST_SQL)
def q_domain_best(spark, sf_dir):
    best = D.best_domain_frame(D.domain_scores(tables.table(spark, sf_dir, "events")))
    return best.withColumn("reason", F.array_join("reason", " | "))


@register("domain_best_records", REC_DOMAIN + BEST_SQL)
def q_domain_best_records(spark, sf_dir):
    best = D.best_domain_frame(D.domain_scores(tables.records(spark, sf_dir)))
    return best.withColumn("reason", F.array_join("reason", " | "))


def _best(spark, sf_dir, name):
    return D.best_domain_frame(D.domain_scores(tables.table(spark, sf_dir, name))).withColumn("reason", F.array_join("reason", " | "))


@register("domain_best_documents", domain_sql("", "documents", DOC_WORDS) + BEST_SQL)
def q_domain_best_documents(spark, sf_dir):
    return _best(spark, sf_dir, "documents")


@register("domain_best_conversations", domain_sql("", "conversations", TALK_WORDS) + BEST_SQL)
def q_domain_best_conversations(spark, sf_dir):
    return _best(spark, sf_dir, "conversations")


@register("domain_best_pages", domain_sql("", "pages", PAGE_WORDS) + BEST_SQL)
def q_domain_best_pages(spark, sf_dir):
    return _best(spark, sf_dir, "pages")


EVENT_KEYWORDS = ("event", "page", "click", "item", "unit", "value", "user", "ref_low", "purchase")


@register("domain_evidence", "WITH texts AS (SELECT 'event_type' AS \"column\", concat(' ', trim(regexp_replace(lower(event_type), '[^a-z0-9]+', ' ', 'g')), ' ') AS t FROM events "
          "UNION ALL SELECT 'props', concat(' ', trim(regexp_replace(lower(props), '[^a-z0-9]+', ' ', 'g')), ' ') FROM events),\n"
          "sizes AS (SELECT \"column\", COUNT(*) AS filled, CAST(sum(length(t) - length(replace(t, ' ', '')) - 1) AS BIGINT) AS words FROM texts WHERE t IS NOT NULL GROUP BY 1)\n"
          + "\nUNION ALL ".join(f"""SELECT s."column", '{k}' AS keyword, (SELECT count(*) FROM texts t WHERE t."column" = s."column" AND contains(t.t, ' {k.replace('_', ' ')} ')) AS hits, filled, words FROM sizes s"""
                                for k in EVENT_KEYWORDS))
def q_domain_evidence(spark, sf_dir):
    return D.evidence(tables.table(spark, sf_dir, "events"), list(EVENT_KEYWORDS)).drop("weight")


# ---------------------------------------------------------------- recommendations
@register("recommend_rules", REC_PROFILE.rstrip() + """,
nums AS (
  SELECT 4 AS position, value AS x FROM rec UNION ALL SELECT 7, ref_low FROM rec UNION ALL SELECT 8, ref_high FROM rec
),
q AS (SELECT position, quantile_cont(x, 0.25) AS q0, quantile_cont(x, 0.75) AS q1 FROM nums WHERE x IS NOT NULL
      GROUP BY position),
p AS (SELECT prof.*, q.q0, q.q1 FROM prof LEFT JOIN q USING (position)),
r AS (
  SELECT "column", position, 'missing_value' AS type, TRUE AS enabled,
         CAST(floor(null_ratio * 100) AS BIGINT) + 10 AS threshold_warning,
         CAST(floor(null_ratio * 100) AS BIGINT) + 25 AS threshold_critical, CAST(NULL AS BOOLEAN) AS allow_nulls,
         CAST(NULL AS BOOLEAN) AS check_future, CAST(NULL AS INTEGER) AS max_age_days,
         CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound, CAST(NULL AS BIGINT) AS max_unique
  FROM p WHERE null_ratio > 0
  UNION ALL SELECT "column", position, 'duplicate', TRUE, NULL, NULL, null_ratio > 0, NULL, NULL, NULL, NULL, NULL
  FROM p WHERE semantic_role = 'id'
  UNION ALL SELECT "column", position, 'date_range', TRUE, NULL, NULL, NULL, TRUE, 365, NULL, NULL, NULL
  FROM p WHERE semantic_role = 'date' OR inferred_type = 'date'
  UNION ALL SELECT "column", position, 'outlier', TRUE, NULL, NULL, NULL, NULL, NULL,
         q0 - 1.5 * (q1 - q0), q1 + 1.5 * (q1 - q0), NULL
  FROM p WHERE inferred_type = 'numeric' AND q0 IS NOT NULL
  UNION ALL SELECT "column", position, 'cardinality', FALSE, NULL, NULL, NULL, NULL, NULL, NULL, NULL, unique_count * 2
  FROM p WHERE inferred_type = 'categorical'
)
SELECT "column", position, type, enabled, threshold_warning, threshold_critical, allow_nulls, check_future,
       max_age_days, round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound, max_unique FROM r""")
def q_recommend_rules(spark, sf_dir):
    r = R.recommend_rules(tables.records(spark, sf_dir))
    return r.withColumn("lower_bound", F.round("lower_bound", 4)).withColumn("upper_bound", F.round("upper_bound", 4))
