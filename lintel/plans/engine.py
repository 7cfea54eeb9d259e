"""Rule engine: every enabled rule of a pack in one plan.

Plan shape for ``RuleEngine(rules).issues(df)``:

* global statistics, only for rules that need them (row total and blank
  counts, approximate distinct counts and quartile sketches): ONE aggregate
  over the table, read into the row pass as a scalar subquery.  Exact distinct
  counts add one unpivot aggregate; exact quartiles add two scans
  that shuffle a small share of the values, shared by all IQR columns;
* duplicate counts per duplicate-rule column: partial aggregate + hot/cold
  join-back (``operators.groups``);
* one row pass: ``concat`` of one ``CASE WHEN violated THEN array(struct(issue))
  ELSE empty END`` per (rule, column) check - compiled as SQL text and parsed
  once - then an outer generator and a null filter, one output row per
  violation.  Row-local rules therefore cost one scan and no exchange.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lintel import config
from lintel.functions.columns import protect_reserved
from lintel.operators import sketches
from lintel.operators.groups import DEFAULT_HOT_FRACTION, attach_group_count
from lintel.operators.quantiles import approx_quantiles, exact_quantiles_grouped
from lintel.operators.rules import SUPPORTED_RULES, Bindings, Check, RuleCompiler
from lintel.operators.stats import colref, distinct_counts
from lintel.functions import sqltext as S
from lintel.functions.values import as_double, blank
from lintel.schemas import ISSUE_STRUCT

logger = logging.getLogger("lintel")

ISSUES = "issues"


@dataclass
class EngineOptions:
    review_date: str = config.REVIEW_DATE
    quantiles: str = "exact"            # "exact" (sketch, then exact counts inside its interval) or "approx" (sketch only)
    quantile_error: float = config.APPROX_QUANTILE_ERROR
    distinct: str = "exact"             # "exact" (unpivot aggregate) or "approx" (HLL++)
    distinct_error: float = 0.05
    distinct_state: DataFrame | None = None   # kept sketches (operators.sketches): distinct counts without reading the table
    hot_fraction: float = DEFAULT_HOT_FRACTION
    duplicate_strategy: str = "join"    # "join" (skew-safe) or "window" (one exchange, unskewed keys)
    # Write an expensive input (e.g. a join) once to spark.checkpoint.dir when the rules need more
    # than one pass over it (statistics, duplicate counts), instead of recomputing it per pass.
    materialize_input: bool = False


ISSUE_POSITION = "issue_position"


def explode_issues(annotated: DataFrame, with_position: bool = False) -> DataFrame:
    """One row per issue.  An outer generator + a null test on the (never-null) issue type, because
    plain ``inline`` makes the optimizer infer ``size(issues) > 0`` and push that whole array
    expression below the generator - into a join condition, where it is evaluated again per pair.

    ``with_position`` adds the issue's index in its row: rows with index 0 are the flagged rows,
    so flagged-row counts need no row id.
    """
    cols = [colref(c) for c in annotated.columns if c != ISSUES]
    if not with_position:
        return annotated.select(*cols, F.inline_outer(ISSUES)).where(F.col("issue_type").isNotNull())
    exploded = annotated.select(*cols, F.posexplode_outer(ISSUES).alias(ISSUE_POSITION, "__issue"))
    fields = [F.col("__issue")[f.name].alias(f.name) for f in ISSUE_STRUCT.fields]
    return exploded.select(*cols, *fields, ISSUE_POSITION).where(F.col("issue_type").isNotNull())


class RuleEngine:
    def __init__(self, rules: Sequence[dict] | None, **options):
        self.rules = list(rules or [])
        self.options = EngineOptions(**options)

    # ------------------------------------------------------------------ compile
    def active_rules(self) -> list[dict]:
        out = []
        for rule in self.rules:
            if not rule.get("enabled", True):
                continue
            if rule.get("type") not in SUPPORTED_RULES:
                logger.warning("no check exists for rule type %r; rule %s is left out", rule.get("type"), rule.get("id"))
                continue
            out.append(rule)
        return out

    def compile(self, df: DataFrame) -> tuple[list[Check], RuleCompiler]:
        compiler = RuleCompiler(df.schema, self.options.review_date)
        checks: list[Check] = []
        for rule in self.active_rules():
            checks.extend(compiler.compile(rule))
        return checks, compiler

    def resolution(self, df: DataFrame) -> DataFrame:
        """Which columns each rule resolved to, and what was skipped and why (plan-time metadata)."""
        _, comp = self.compile(protect_reserved(df))
        rows = [(r, t, c, "checked", None) for r, t, c in comp.resolved]
        rows += [(r, None, c, "skipped", why) for r, c, why in comp.skipped]
        return df.sparkSession.createDataFrame(
            rows, "rule_id string, type string, column string, status string, reason string")

    # ------------------------------------------------------------------ statistics
    def _bind_stats(self, df: DataFrame, comp: RuleCompiler) -> tuple[DataFrame, list[str]]:
        req, opts = comp.stats, self.options
        types = {f.name: f.dataType for f in df.schema.fields}
        helper: list[str] = []
        out = df
        base = df
        for i, c in enumerate(req.group_counts):
            name = Bindings.group_count_name(i)
            out = attach_group_count(out, [c], name, hot_fraction=opts.hot_fraction,
                                     strategy=opts.duplicate_strategy, counts_from=base)
            helper.append(name)
        # Global aggregates (row total, blank counts, approximate distinct counts and quartile
        # sketches) share ONE aggregate over the input - one scan, one scalar subquery.
        glob = []
        if req.blank:
            glob.append(F.count(F.lit(1)).alias("total"))
            glob += [F.count_if(blank(colref(c), types[c])).alias(f"b{i}") for i, c in enumerate(req.blank)]
        if req.distinct and opts.distinct == "approx" and opts.distinct_state is None:
            glob += [(F.approx_count_distinct(colref(c), opts.distinct_error)
                      + F.max(colref(c).isNull()).cast("long")).alias(f"d{i}") for i, c in enumerate(req.distinct)]
        xs = [as_double(colref(c), types[c]) for c in req.quantiles]
        if xs and opts.quantiles != "exact":
            glob += [approx_quantiles(x, [0.25, 0.75], opts.quantile_error).alias(f"__a{i}") for i, x in enumerate(xs)]
        if glob:
            g = base.agg(*glob)
            fields = [F.col(c) for c in g.columns if not c.startswith("__a")]
            if xs and opts.quantiles != "exact":
                fields += [F.col(f"__a{i}")[k].alias(f"{name}_{i}") for i in range(len(xs))
                           for k, name in ((0, "q1"), (1, "q3"))]
            out = out.withColumn(Bindings.STATS, g.select(F.struct(*fields)).scalar())
            helper.append(Bindings.STATS)
        if req.distinct:
            if opts.distinct == "approx" and opts.distinct_state is None:
                out = out.withColumn(Bindings.DISTINCT, F.col(Bindings.STATS))
            else:
                d = distinct_counts(base, req.distinct) if opts.distinct_state is None else sketches.distinct_counts(opts.distinct_state, req.distinct)
                out = out.withColumn(Bindings.DISTINCT, d.select(F.struct(*d.columns)).scalar())
            helper.append(Bindings.DISTINCT)
        if xs:
            if opts.quantiles == "exact":
                # All IQR columns share one grouped, distributed exact selection.
                pairs = F.array(*[F.struct(F.lit(i).alias("g"), x.alias("x")) for i, x in enumerate(xs)])
                per = exact_quantiles_grouped(base.select(F.inline(pairs)), "g", "x", [0.25, 0.75])
                q = per.agg(*[F.max(F.when(F.col("g") == i, F.col(f"q{k}"))).alias(f"{name}_{i}")
                              for i in range(len(xs)) for k, name in ((0, "q1"), (1, "q3"))])
                out = out.withColumn(Bindings.QUARTILES, q.select(F.struct(*q.columns)).scalar())
            else:
                out = out.withColumn(Bindings.QUARTILES, F.col(Bindings.STATS))
            helper.append(Bindings.QUARTILES)
        return out, helper

    # ------------------------------------------------------------------ outputs
    def annotate(self, df: DataFrame) -> DataFrame:
        """Input rows (reserved names protected) plus an ``issues`` array column."""
        df = protect_reserved(df)
        checks, comp = self.compile(df)
        req = comp.stats
        if self.options.materialize_input and (req.blank or req.distinct or req.quantiles or req.group_counts):
            from lintel.session import ensure_checkpoint_dir
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint(eager=True)  # reliable checkpoint: survives executor loss
        bound, helper = self._bind_stats(df, comp)
        # One single-element array per violated check, concatenated: plain CASE/array/concat
        # code generates inside the scan's whole-stage stage (a higher-order filter would not).
        # The expression is built as SQL text and parsed once by Spark.
        issue_type = f"array<{ISSUE_STRUCT.simpleString()}>"
        empty = f"CAST(array() AS {issue_type})"
        parts = [
            f"CASE WHEN {ch.cond} THEN array(named_struct("
            f"'issue_type', {S.string(ch.issue_type)}, 'issue_column', {S.string(ch.issue_column)}, "
            f"'rule_id', {S.string(ch.rule_id)}, 'rule_severity', CAST({ch.severity} AS STRING), "
            f"'metric_value', CAST({ch.metric if ch.metric is not None else 'NULL'} AS DOUBLE))) ELSE {empty} END"
            for ch in checks
        ]
        if not parts:
            text = empty
        elif len(parts) == 1:
            text = parts[0]
        else:
            text = "concat(" + ",\n".join(parts) + ")"
        issues = F.expr(text)
        return bound.withColumn(ISSUES, issues).drop(*helper)

    def issues(self, df: DataFrame) -> DataFrame:
        """Long form: every input column plus the five issue columns, one row per violation."""
        return explode_issues(self.annotate(df))

    def run(self, df: DataFrame) -> DataFrame:
        return self.issues(df)
