"""Mixing sources to target weights by subset-sum budget fitting.

Words per source and exact length are counted; each source's target is its share
of the whole budget (water-filled below a cap of whole passes over the source).
A source first takes whole passes over all its documents; the rest of its budget
is spread over the lengths in proportion, and what rounding leaves is fitted by a
bounded-knapsack dynamic program over the lengths still available.  The result is
a number of extra documents per (source, length); seeded ranks pick which.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lintel.llm.common import NOT_WHITE, checkpointed, fresh

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
DP_WORDS = 32768       # sums that the dynamic program tells apart; more words than that are counted in larger units first
NEAR = 4096
BUCKET_ROWS = 20000    # ranks are taken in seeded buckets of about so many documents
SEED = 20


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_WHITE)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` -> the same with ``target``.

    Sources are ordered by code point, null last, and weighted by ``weights`` in
    turn.  Targets share ``share`` of all sizes by weight; a target stops at
    ``most`` times its source's size and the excess is shared again among the rest:
    the level L with sum(min(most * size, L * weight)) = budget.  In the order of
    most * size / weight the sources below the level are a prefix, so running sums
    find it.  One row per source meets in the window.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))).cast("int"))
    rows = sources.withColumn("w", turn).withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    full = Window.partitionBy(F.lit(1))
    rows = rows.withColumns({"all": F.sum(F.col("source_size")).over(full).cast("double"),
                             "spent": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "open": F.sum("w").over(after)})
    # The level if this source and all later ones stayed below their caps; the true level is the least feasible one.
    rows = rows.withColumn("level", (F.col("all") * share - F.col("spent")) / F.col("open"))
    feasible = F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))
    first = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("reached", F.coalesce(F.first(feasible, ignorenulls=True).over(first), F.lit(float("inf"))))
    return rows.select("source", "source_size", F.least(F.col("cap"), F.col("reached") * F.col("w")).alias("target"))


def knapsack(lengths: np.ndarray, spare: np.ndarray, left: int) -> np.ndarray:
    """How many of each length, at most ``spare``, make the greatest sum up to ``left``; binary splitting."""
    take = np.zeros(len(lengths), np.int64)
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    by = np.full(left + 1, -1, np.int64)     # the item that first reached a sum
    items: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable"):
        more, part = min(int(spare[i]), left // int(lengths[i])), 1
        while more > 0 and not reached[left]:
            part = min(part, more)
            step = int(lengths[i]) * part
            new = np.zeros(left + 1, bool)
            new[step:] = reached[: left + 1 - step]
            new &= ~reached
            by[new] = len(items)
            reached |= new
            items.append((int(i), part))
            more -= part
            part *= 2
        if reached[left]:
            break
    at = int(np.nonzero(reached)[0][-1])
    while at:
        i, part = items[by[at]]
        take[i] += part
        at -= int(lengths[i]) * part
    return take


def fill(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int) -> np.ndarray:
    """``take`` and what the dynamic program adds to it, up to ``budget``."""
    take, left = take.copy(), budget - int((take * lengths).sum())
    while left >= DP_WORDS:
        unit = left // DP_WORDS + 1
        more = knapsack(-(-lengths // unit), counts - take, left // unit)
        if not more.any():
            return take
        take += more
        left -= int((more * lengths).sum())
    # A few documents are given back, so that the program has lengths to choose from.
    for i in np.argsort(lengths, kind="stable").tolist() * 8:
        if left < DP_WORDS // 8 and take[i] > 0:
            take[i] -= 1
            left += int(lengths[i])
    return take + knapsack(lengths, counts - take, left)


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near ``budget`` as can be.

    ``lengths`` are distinct and positive.  Proportional parts first, rounded down;
    then one more of the lengths with the largest fractions while it fits; the rest
    by bounded knapsack, never above the budget: in units of several words, rounded
    up, while more than ``DP_WORDS`` are left, then word by word.  While that misses the
    budget by more than one part in ``NEAR``, half of the first parts are given back.
    """
    take = np.zeros(len(lengths), np.int64)
    whole = int((lengths * counts).sum())
    if budget <= 0 or whole == 0:
        return take
    if budget >= whole:
        return counts.astype(np.int64)
    exact = counts * (budget / whole)
    take = np.floor(exact).astype(np.int64)
    left = budget - int((take * lengths).sum())
    order = np.argsort(-(exact - take), kind="stable")
    for i in order:
        if left < DP_WORDS // 2:
            break
        if take[i] < counts[i] and lengths[i] <= left:
            take[i] += 1
            left -= int(lengths[i])
    best = fill(lengths, counts, take, budget)
    short = budget - int((best * lengths).sum())
    while short * NEAR > budget and take.any():
        take = take // 2
        other = fill(lengths, counts, take, budget)
        if (left := budget - int((other * lengths).sum())) < short:
            best, short = other, left
    return best


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size").reset_index(drop=True)
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    whole, target = int((lengths * counts).sum()), float(rows["target"].iloc[0])
    passes = min(int(target // whole), MOST) if whole else 0
    real = lengths > 0
    rows["passes"], rows["extra"] = np.where(real := lengths > 0, passes, 0), 0
    if passes < MOST:
        rows.loc[real, "extra"] = fit(lengths[real], counts[real], int(round(target - passes * whole)))
    return rows[["source", "size", "n", "source_size", "target", "passes", "extra"]]


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE, most: int = MOST, seed: int = SEED, whole_rows: bool = False) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, or with ``whole_rows`` the documents themselves, repeated as taken.

    A document is taken 0 to ``most`` times, whole.  Null text has size 0 and is
    never taken; a null source is a source of its own; equal rows are
    interchangeable; an empty table gives no rows.  Reruns agree: ranks depend on
    the seed, the id and the text only.  No group is gathered: ranks are taken in
    seeded buckets whose counts are summed first.
    """
    if whole_rows:
        names = {n: fresh(n, docs) for n in ("size", "source", "h", "mark")}
        rows = docs.withColumns({names["size"]: size_of(F.col(text)), names["source"]: F.col(source),
                                 names["h"]: F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(F.col(text)))})
        meta = rows.select(F.col(names["source"]).alias("source"), F.col(names["size"]).alias("size"), F.col(names["h"]).alias("h"), F.col(key).alias("id"))
    else:
        meta = docs.select(F.col(source).alias("source"), size_of(F.col(text)).alias("size"),
                           F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(F.col(text))).alias("h"), F.col(key).alias("id"))
    meta = checkpointed(meta)
    lengths = checkpointed(meta.groupBy("source", "size").agg(F.count("*").alias("n")))
    aims = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most)
    with_aims = lengths.withColumnRenamed("source", "s").join(aims, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    plan = checkpointed(with_aims.groupBy("source").applyInPandas(
        _plan, f"source {dict(lengths.dtypes)['source']}, size long, n long, source_size long, target double, passes int, extra long"))
    key_plan = plan.withColumnRenamed("source", "ps").withColumnRenamed("size", "pz")
    placed = meta.join(key_plan, F.col("source").eqNullSafe(F.col("ps")) & (F.col("size") == F.col("pz"))).drop("ps", "pz")
    # Whole groups need no ranks; the others are ranked bucket by bucket behind the buckets' running counts.
    some = placed.where("extra > 0 and extra < n").withColumn("bucket", F.pmod(F.col("h"), F.ceil(F.col("n") / BUCKET_ROWS)))
    group = ["source", "size"]
    ahead = some.groupBy(*group, "bucket").agg(F.count("*").alias("here")).withColumn(
        "ahead", F.sum("here").over(Window.partitionBy(*group).orderBy("bucket")) - F.col("here"))
    ahead = ahead.select(F.col("source").alias("bs"), F.col("size").alias("bz"), F.col("bucket").alias("bb"), "here", "ahead")
    in_bucket = some.join(ahead, F.col("source").eqNullSafe(F.col("bs")) & (F.col("size") == F.col("bz")) & (F.col("bucket") == F.col("bb")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "id"))
    edge = in_bucket.where("ahead < extra and ahead + here > extra").withColumn("more", (F.col("ahead") + rank <= F.col("extra")).cast("int"))
    clear = in_bucket.where("not (ahead < extra and ahead + here > extra)").withColumn("more", (F.col("ahead") + F.col("here") <= F.col("extra")).cast("int"))
    rest = placed.where("extra = 0 or extra >= n").withColumn("more", (F.col("extra") > 0).cast("int"))
    cols = ["id", "source", "size", "h", "source_size", "target", "passes", "more"]
    done = rest.select(*cols).unionByName(edge.select(*cols)).unionByName(clear.select(*cols))
    times = F.col("passes") + F.col("more")
    if not whole_rows:
        return done.select(F.col("id").alias("doc_id"), F.col("size"), F.col("source_size"), F.col("target"), (times * F.col("size")).cast("long").alias("taken"))
    # Equal (source, size, hash) rows are equal documents: how many of them are taken, and how often, is summed before joining back.
    own = {n: fresh(n, rows) for n in ("s", "z", "hash", "id", "sum", "of")}
    taken = done.groupBy("source", "size", "h", "id").agg(F.sum(times).cast("long").alias(own["sum"]), F.count("*").alias(own["of"]))
    taken = taken.withColumnsRenamed({"source": own["s"], "size": own["z"], "h": own["hash"], "id": own["id"]})
    out = rows.join(taken, F.col(names["source"]).eqNullSafe(F.col(own["s"])) & (F.col(names["size"]) == F.col(own["z"])) & (F.col(names["h"]) == F.col(own["hash"]))
                    & F.col(key).eqNullSafe(F.col(own["id"])))
    lot = Window.partitionBy(*[own[n] for n in ("s", "z", "hash", "id")]).orderBy(F.lit(1))
    whole, of = F.col(own["sum"]), F.col(own["of"])
    single = out.where(of == 1).withColumn(names["mark"], whole)
    many = out.where(of > 1).withColumn(names["mark"], F.floor(whole / of) + (F.row_number().over(lot) <= whole % of).cast("int"))
    both = single.unionByName(many).where(F.col(names["mark"]) > 0)
    both = both.withColumn(names["mark"], F.explode(F.sequence(F.lit(1), F.col(names["mark"]).cast("int"))))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns])
