"""A review run: pick the check path, build lazy outputs, write them as one version, publish it.

``Review(df, ...)`` builds plans only, but for auto mode, which first reads the table (or a
bounded preview of it) to choose its domain.  ``write(out_dir)`` runs them into a new
folder ``versions/<run_id>``: the issue rows are written once, in the format asked for, and
the summary, the totals and the comparison with the SQL form are computed from what was
written.  The last step appends one row to ``manifests``, which names all outputs of the
run.  Readers follow the newest manifest row (``read_back``), so a run whose driver was
lost leaves the version before it valid, and a rerun leaves exactly one newer one.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from lintel import config, packs
from lintel.functions.messages import add_drafted_messages
from lintel.functions.severity import score_clinical, score_rules
from lintel.operators import clinical, reports
from lintel.operators.preview import FRACTION, preview
from lintel.operators.stats import colref
from lintel.plans.engine import ISSUE_POSITION, ISSUES, RuleEngine, explode_issues
from lintel.schemas import RECORD_COLUMNS
from lintel.sources import io

logger = logging.getLogger("lintel")

CLINICAL_EXPORT = RECORD_COLUMNS + ["issue_type", "severity", "drafted_query"]
RULE_EXPORT_FRONT = ["issue_type", "issue_column", "rule_id", "severity", "drafted_query"]


def looks_clinical(columns) -> bool:
    return set(RECORD_COLUMNS) <= set(columns)


def export_projection(flagged: DataFrame, clinical_mode: bool) -> DataFrame:
    if clinical_mode:
        return flagged.select(*[c for c in CLINICAL_EXPORT if c in flagged.columns])
    front = [c for c in RULE_EXPORT_FRONT if c in flagged.columns]
    return flagged.select(*front, *[colref(c) for c in flagged.columns if c not in front])


def flat_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text and binary as base64, for formats that hold plain values only."""
    def plain(f):
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(colref(f.name)).alias(f.name)
        return F.base64(colref(f.name)).alias(f.name) if isinstance(f.dataType, T.BinaryType) else colref(f.name)
    return df.select(*[plain(f) for f in df.schema.fields])


@dataclass
class Review:
    df: DataFrame
    rules: list[dict] | None = None
    mode: str = "auto"                      # auto | clinical | configurable
    review_date: str = config.REVIEW_DATE
    stale_days: int = config.STALE_DATA_DAYS
    high_threshold: float = config.HIGH_SEVERITY_THRESHOLD
    engine_options: dict = field(default_factory=dict)
    domain: dict | None = None
    cross_check: bool = True                 # clinical path: compare with the SQL form on write
    input_path: str | None = None            # where the table came from, for the metadata
    preview_rows: int | None = None          # classify a bounded preview of so many rows instead of the table

    def __post_init__(self):
        if self.mode not in ("auto", "clinical", "configurable"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.mode == "clinical" and not looks_clinical(self.df.columns):
            missing = sorted(set(RECORD_COLUMNS) - set(self.df.columns))
            raise ValueError(f"clinical mode needs columns {missing}")
        self.clinical_mode = (self.mode == "clinical" or (self.mode == "auto" and not self.rules
                                                          and looks_clinical(self.df.columns)))
        if not self.clinical_mode and not self.rules:
            from lintel.operators.domain import best_domain
            self.domain = self.domain or best_domain(self.df if self.preview_rows is None else self.preview(self.preview_rows).drop(FRACTION))
            self.pack_id = self.domain["domain"] if self.domain["domain"] in packs.PACK_IDS else "generic"
            self.rules = packs.get_pack(self.pack_id, fallback=True)["rules"]
        else:
            self.pack_id = None
        opts = {"review_date": self.review_date, **self.engine_options}
        self.engine = None if self.clinical_mode else RuleEngine(self.rules, **opts)

    # ------------------------------------------------------------- lazy plans
    def preview(self, rows: int = 200) -> DataFrame:
        """At most ``rows`` rows of the input, the same on every run, with the share of all rows that they are."""
        return preview(self.df, rows)

    def annotated(self) -> DataFrame:
        """Configurable path: every input row with its ``issues`` array."""
        if self.clinical_mode:
            raise ValueError("the clinical path has one issue per row; use flagged()")
        return self.engine.annotate(self.df)

    def flagged(self) -> DataFrame:
        """Issue rows: clinical (one per flagged row) or long form (one per violation)."""
        if self.clinical_mode:
            return clinical.run_checks_dataframe(self.df, self.review_date, self.stale_days)
        return self.engine.issues(self.df)

    def scored(self, flagged: DataFrame | None = None) -> DataFrame:
        f = flagged if flagged is not None else self.flagged()
        return add_drafted_messages(score_clinical(f, self.high_threshold) if self.clinical_mode else score_rules(f))

    def issues(self) -> DataFrame:
        """Issue rows with severity and reviewer message (lazy)."""
        return self.scored()

    def summary(self, scored: DataFrame | None = None) -> DataFrame:
        s = scored if scored is not None else self.scored()
        return reports.summary_ranked(s) if self.clinical_mode else reports.summary_generic(s)

    def totals(self) -> DataFrame:
        if self.clinical_mode:
            return reports.clinical_totals(self.df, self.flagged())
        return reports.run_totals(self.annotated())

    def queue(self, top: int | None = None) -> DataFrame:
        return reports.review_queue(self.scored(), top)

    def metadata(self) -> DataFrame:
        """Lazy one-row run summary (counts come from scalar subqueries; nothing is collected)."""
        spark = self.df.sparkSession
        total = self.df.agg(F.count(F.lit(1))).scalar()
        if self.clinical_mode:
            flagged = self.flagged().agg(F.count(F.lit(1))).scalar()
            issues = flagged
        else:
            ann = self.annotated()
            flagged = ann.agg(F.count_if(F.size(ISSUES) > 0)).scalar()
            issues = ann.agg(F.coalesce(F.sum(F.size(ISSUES)), F.lit(0)).cast("long")).scalar()
        return spark.range(1).select(
            F.lit(self.clinical_mode).alias("clinical_mode"), F.lit(self.pack_id).cast("string").alias("rule_pack"),
            total.alias("total_records"), issues.alias("issues"), flagged.alias("flagged_records"),
            (total - flagged).alias("clear_records"))

    # ------------------------------------------------------------- execution
    def write(self, out_dir: str, fmt: str = "csv") -> dict:
        """Run the review once and publish issue rows, summary, rule resolution and metadata as one version under ``out_dir``.

        On the configurable path the issue rows end with ``issue_position``, an issue's place in its row: place 0
        marks a flagged row, so flagged rows need no row id.
        """
        spark = self.df.sparkSession
        out = io.Version(spark, out_dir, uuid.uuid4().hex)
        if self.clinical_mode:
            found = self.flagged()
        else:
            found = explode_issues(self.annotated(), with_position=True)
        export = export_projection(self.scored(found), self.clinical_mode)
        if not self.clinical_mode:
            export = export.select(*[colref(c) for c in export.columns if c != ISSUE_POSITION], colref(ISSUE_POSITION).alias("issue_position"))
        rows = out.add("flagged_records", flat_text(export) if fmt == "csv" else export, fmt)

        validated = None
        if self.clinical_mode and self.cross_check:
            sql = clinical.run_checks_sql(spark, self.df, self.review_date, self.stale_days)
            validated = clinical.cross_validate(rows, sql)
        summary = out.add("summary_report", self.summary(rows), "csv")
        if not self.clinical_mode:
            # Which columns each rule checked, and what was skipped and why (plan-time metadata).
            out.add("rule_resolution", self.engine.resolution(self.df).coalesce(1), "csv")

        total = int(self.df.count())
        issues = int(summary.agg(F.coalesce(F.sum("flagged_count"), F.lit(0))).first()[0])
        flagged = issues if self.clinical_mode else int(rows.where(F.col("issue_position") == 0).count())
        meta = {
            "run_id": out.run_id,
            "input_path": self.input_path,
            "detected_domain": self.domain,
            "rule_pack": self.pack_id,
            "clinical_mode": self.clinical_mode,
            "clinical_sql_validated": validated,
            "total_records": total,
            "issues": issues,
            "flagged_records": flagged,
            "clear_records": total - flagged,
        }
        out.add("run_metadata", metadata_frame(spark, meta).coalesce(1), "json")
        out.publish(dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds"))
        return meta


def metadata_frame(spark, meta: dict) -> DataFrame:
    """Run metadata as a one-row DataFrame (the domain profile travels as JSON text)."""
    row = {k: (json.dumps(v) if isinstance(v, (dict, list)) else v) for k, v in meta.items()}
    names = ["run_id", "input_path", "detected_domain", "rule_pack", "clinical_mode", "clinical_sql_validated", "total_records",
             "issues", "flagged_records", "clear_records"]
    schema = ("run_id string, input_path string, detected_domain string, rule_pack string, clinical_mode boolean, clinical_sql_validated boolean, "
              "total_records long, issues long, flagged_records long, clear_records long")
    return spark.createDataFrame([tuple(row.get(k) for k in names)], schema)


def review(df: DataFrame, rules: list[dict] | None = None, review_date: str = config.REVIEW_DATE, **kw) -> Review:
    """Build a lazy review: ``.issues() .summary() .totals() .queue()``; ``.write(dir)`` runs it."""
    return Review(df, rules=rules, review_date=review_date, **kw)


def review_path(spark, path: str, fmt: str | None = None, **kw) -> Review:
    """Review a stored table; one without rows is an error, on both check paths."""
    return Review(io.read_table(spark, path, fmt, check_empty=True), input_path=path, **kw)
