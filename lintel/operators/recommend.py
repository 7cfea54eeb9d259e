"""Rule recommendations from a table profile (H10).

Per column, in order:
* missing_value when the column has nulls, thresholds int(ratio*100)+10
  (warning) and +25 (critical) - above today's ratio, so it guards drift;
* duplicate when the column's role is id (nulls ignored when it has nulls);
* date_range (future dates, 365-day age) when role or type is date;
* outlier with fixed IQR bounds (1.5 x IQR around exact quartiles of the
  values that parse as numbers) when the type is numeric;
* cardinality, disabled, max_unique = 2 x distinct values, when categorical.

The quartiles of all numeric columns come from one grouped, distributed
exact-quantile job.  Output: one row per recommended rule.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from lintel.functions.values import DATE_TYPES, NUMERIC_TYPES, looks_numeric
from lintel.operators.profile import profile as build_profile, value_text
from lintel.operators.quantiles import exact_quantiles_grouped
from lintel.operators.stats import colref

RULE_SCHEMA = ("column string, position int, type string, enabled boolean, threshold_warning long, "
               "threshold_critical long, allow_nulls boolean, check_future boolean, max_age_days int, "
               "lower_bound double, upper_bound double, max_unique long")


def numeric_quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """(position, q0, q1) = exact first and third quartiles of the values that parse as numbers (no text is shuffled)."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def number(c):
        if isinstance(types[c], NUMERIC_TYPES):
            return colref(c).cast("double")
        text = value_text(colref(c), types[c])
        return F.when(looks_numeric(text), text.try_cast("double"))

    pairs = [F.struct(F.lit(i).alias("position"), number(c).alias("x")) for i, c in enumerate(columns) if not isinstance(types[c], DATE_TYPES + (T.BooleanType,))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "position int, q0 double, q1 double")
    return exact_quantiles_grouped(df.select(F.inline(F.array(*pairs))), "position", "x", [0.25, 0.75])


def recommend_rules(df: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    prof = prof if prof is not None else build_profile(df)
    p = prof.select("column", "position", "inferred_type", "semantic_role", "null_ratio", "unique_count")
    spark = df.sparkSession
    none_l, none_b, none_i, none_d = (F.lit(None).cast(t) for t in ("long", "boolean", "int", "double"))
    pct = F.floor(F.col("null_ratio") * 100).cast("long")

    def rule(kind, enabled=F.lit(True), tw=none_l, tc=none_l, an=none_b, cf=none_b, age=none_i, lo=none_d,
             hi=none_d, mu=none_l):
        return F.struct(F.lit(kind).alias("type"), enabled.alias("enabled"), tw.alias("threshold_warning"),
                        tc.alias("threshold_critical"), an.alias("allow_nulls"), cf.alias("check_future"),
                        age.alias("max_age_days"), lo.alias("lower_bound"), hi.alias("upper_bound"),
                        mu.alias("max_unique"))

    # Quartiles of every column's number-like values (non-numbers drop out map-side); only
    # numeric columns use them.  No driver round trip to learn which columns are numeric.
    cols = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.BinaryType)]
    q = numeric_quartiles(df, cols)
    p = p.join(q, "position", "left")
    iqr = F.col("q1") - F.col("q0")
    candidates = F.array(
        F.when(F.col("null_ratio") > 0, rule("missing_value", tw=pct + 10, tc=pct + 25)),
        F.when(F.col("semantic_role") == "id", rule("duplicate", an=F.col("null_ratio") > 0)),
        F.when((F.col("semantic_role") == "date") | (F.col("inferred_type") == "date"),
               rule("date_range", cf=F.lit(True), age=F.lit(365))),
        F.when((F.col("inferred_type") == "numeric") & F.col("q0").isNotNull(),
               rule("outlier", lo=F.col("q0") - 1.5 * iqr, hi=F.col("q1") + 1.5 * iqr)),
        F.when(F.col("inferred_type") == "categorical",
               rule("cardinality", enabled=F.lit(False), mu=F.col("unique_count") * 2)),
    )
    out = p.select("column", "position", F.inline(F.filter(candidates, lambda r: r.isNotNull())))
    return spark.createDataFrame([], RULE_SCHEMA).unionByName(out.select(*[f.split()[0] for f in RULE_SCHEMA.split(", ")]))


def rules_from_frame(recommended: DataFrame) -> list[dict]:
    """Driver-side rule dicts from the recommendation table (one small row per rule)."""
    out = []
    for r in recommended.orderBy("position").collect():
        rule = {"type": r["type"], "column": r["column"], "enabled": bool(r["enabled"])}
        for key in ("threshold_warning", "threshold_critical", "allow_nulls", "check_future", "max_age_days",
                    "lower_bound", "upper_bound", "max_unique"):
            if r[key] is not None:
                rule[key] = r[key]
        out.append(rule)
    return out


def rules_json(recommended: DataFrame) -> str:
    return json.dumps(rules_from_frame(recommended), indent=2)
