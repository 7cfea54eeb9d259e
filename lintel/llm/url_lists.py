"""URL filters by a temporal list join, in DataFrame functions only.

Dated list entries (kind, pattern, action, effective_at) become validity intervals:
an entry holds from its date until the next entry of the same pattern.  A capture
asks for its exact URL, its host and every parent domain; each of these keys is
joined with the interval that holds its fetch time, and the most specific answer
decides.  Keys are reduced to distinct (key, time) pairs before the join, so a host
with a third of all captures meets the list once per time stamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lintel.llm.common import fresh

KINDS = ("domain", "host", "url")  # from the least to the most specific


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL, without user, port and a final dot; empty when there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", "")), r"\.$", "")


def plain_url(url: Column) -> Column:
    """The URL as list entries name it: without scheme, user and fragment, host in lower case."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\]*|#.*$", "")
    return F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest))


def intervals(entries: DataFrame) -> DataFrame:
    """``(kind, pattern, action, effective_at)`` -> the same with ``until`` (null: still valid).

    Of entries of one pattern and date the greatest action counts ('block' over
    'allow').  Entries with a null in any of the four columns never hold.  Only
    entries that change the action start an interval.
    """
    clean = entries.select("kind", "pattern", "action", "effective_at").dropna()
    daily = clean.groupBy("kind", "pattern", "effective_at").agg(F.max("action").alias("action"))
    line = Window.partitionBy("kind", "pattern").orderBy("effective_at")
    changes = daily.withColumn("before", F.lag("action").over(line)).where("before is null or before <> action").drop("before")
    return changes.withColumn("until", F.lead("effective_at").over(line))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` plus ``decision, matched_kind, matched_pattern, effective_at``, one row per capture.

    ``decision`` is the action of the most specific entry in force at the fetch time
    (the URL itself, then the host, then parent domains from the longest), or 'none'.
    Null URLs or times match nothing.  Numeric hosts have no parent domains.  Repeated captures are answered alike; added
    columns replace input columns of those names.
    """
    own, when, of, then = fresh("own", captures), fresh("when", captures), fresh("of", captures), fresh("then", captures)
    host = host_of(F.col(url))
    labels = F.split(host, r"\.")
    named = ~host.rlike(r"^[0-9.]+$|^\[")  # addresses have no parent domains
    parents = F.when(named & (F.size(labels) > 2), F.transform(F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.struct(
        F.lit(0).alias("rank"), (F.size(labels) - i).alias("depth"), F.lit("domain").alias("kind"),
        F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"))))
    whole = F.array(F.struct(F.lit(2).alias("rank"), F.lit(0).alias("depth"), F.lit("url").alias("kind"), plain_url(F.col(url)).alias("pattern")),
                    F.struct(F.lit(1).alias("rank"), F.lit(0).alias("depth"), F.lit("host").alias("kind"), host.alias("pattern")),
                    F.struct(F.lit(0).alias("rank"), F.size(labels).alias("depth"), F.lit("domain").alias("kind"), host.alias("pattern")))
    asked = captures.select(F.col(url).alias(own), F.col(at).alias(when)).where(F.col(own).isNotNull() & F.col(when).isNotNull()).distinct()
    keyed = asked.withColumnRenamed(own, url).select(F.col(url).alias("u"), F.col(when).alias("t"), F.explode(
        F.concat(whole, F.coalesce(parents, F.array().cast("array<struct<rank:int,depth:int,kind:string,pattern:string>>")))).alias("k"))
    keys = keyed.select("k.kind", "k.pattern", "t").distinct()
    valid = intervals(entries).select(F.col("kind").alias("ik"), F.col("pattern").alias("ip"), "action", "effective_at", "until")
    in_force = keys.join(valid, (F.col("kind") == F.col("ik")) & (F.col("pattern") == F.col("ip")) & (F.col("effective_at") <= F.col("t"))
                         & (F.col("until").isNull() | (F.col("t") < F.col("until")))).select("kind", "pattern", "t", "action", "effective_at")
    in_force = in_force.withColumnsRenamed({"kind": "fk", "pattern": "fp", "t": "ft"})
    best = keyed.join(in_force, (F.col("k.kind") == F.col("fk")) & (F.col("k.pattern") == F.col("fp")) & (F.col("t") == F.col("ft"))).groupBy(F.col("u").alias(of), F.col("t").alias(then)).agg(
        F.max(F.struct("k.rank", "k.depth", "k.kind", "k.pattern", "action", "effective_at")).alias(own))
    added = ["decision", "matched_kind", "matched_pattern", "effective_at"]
    kept = captures.select(*[F.col(f"`{c}`") for c in captures.columns if c not in added])
    out = kept.join(best, (kept[f"`{url}`"] == F.col(of)) & (kept[f"`{at}`"] == F.col(then)), "left")
    return out.select(*[kept[f"`{c}`"] for c in kept.columns], F.coalesce(f"{own}.action", F.lit("none")).alias("decision"), F.col(f"{own}.kind").alias("matched_kind"),
                      F.col(f"{own}.pattern").alias("matched_pattern"), F.col(f"{own}.effective_at").alias("effective_at"))
