"""Sharding by balanced label propagation.

Documents with equal texts are linked.  Every document starts in a seeded shard.  In
each round a linked document wishes to be where most of its neighbours' bytes are;
documents of one group in one shard have the same wish and travel as one piece.  The
wishes between each two shards are granted in a seeded order up to quotas, found so
that no shard passes its capacity by what comes in less what leaves.  Rounds end when
no wish is left or none can be granted.  Groups that are still apart then are dealt,
whole, along the room that is left.  Only a group that no shard has room for is
spread, over as few shards as hold it.
Documents without links then fill the shards to equal sizes, in a seeded order cut
at the shards' remaining needs.  Only the loads of the shards and groups beyond a
fixed part of a shard reach the driver; running sums go through bucket totals.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from lintel.llm.common import checkpointed

SHARDS = 16
ROUNDS = 8             # of propagation at most
FULL = 0.97            # linked documents fill a shard so far at first: the others even the shards out
BIG = 64               # groups above this part of a shard are placed one by one
BUCKET_ROWS = 20000
SEED = 7


def _unit(*cols: Column) -> Column:
    """A seeded number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(2**53)


def running(rows: DataFrame, parts: list[str], bucket: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``rows`` plus the sum of ``value`` over the rows before, within ``parts`` in the order of ``bucket`` and ``order``.

    Sums run inside buckets; what lies before a bucket comes from the buckets' totals.
    """
    totals = rows.groupBy(*parts, bucket).agg(F.sum(value).alias("__here"))
    line = Window.partitionBy(*parts).orderBy(bucket) if parts else Window.orderBy(bucket)
    before = totals.withColumn("__ahead", F.sum("__here").over(line) - F.col("__here")).drop("__here")
    inside = Window.partitionBy(*parts, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn(name, F.sum(value).over(inside) - value).join(before, [*parts, bucket])
            .withColumn(name, F.col(name) + F.col("__ahead")).drop("__ahead"))


def _big(groups: list[tuple[str, int, int]], even: float, shards: int) -> tuple[dict[str, list[float]], list[float]]:
    """Per group the share of it that ends in each shard, summed up, and the shards' loads; groups are ``(name, bytes, goal)``."""
    load, found = [0.0] * shards, {}
    for name, size, goal in sorted(groups, key=lambda g: (-g[1], g[0])):
        part = [0.0] * shards
        order = sorted(range(shards), key=lambda s: (s != goal, load[s], s))
        spare = min(range(shards), key=lambda s: (load[s], s))
        whole = goal if load[goal] + size <= FULL * even else spare if load[spare] + size <= even else None
        if whole is not None:
            part[whole] = float(size)
        else:
            left = float(size)
            for full in (FULL * even, even):
                for s in order:
                    take = min(left, max(0.0, full - load[s] - part[s]))
                    part[s] += take
                    left -= take
            part[spare] += left
        load = [a + b for a, b in zip(load, part, strict=True)]
        total, found[name] = 0.0, []
        for x in part:
            total += x / size
            found[name].append(total)
    return found, load


def _along(middle: Column, needs: list[float], scale: float) -> Column:
    """The shard whose need, one after the other, the place ``middle`` of a running sum falls into."""
    ends, edge = [], 0.0
    for n in needs:
        edge += n * scale
        ends.append(edge)
    last = max((s for s, n in enumerate(needs) if n > 0), default=len(needs) - 1)
    place = F.lit(last)
    for s in range(last - 1, -1, -1):
        place = F.when(middle < ends[s], F.lit(s)).otherwise(place)
    return place.cast("int")


def cut(found: DataFrame, shards: int = SHARDS) -> tuple[int, int, int]:
    """Of what ``shard`` returns: bytes of linked documents, of groups in more than one shard, and of those among them that are no larger than a quarter of a shard."""
    groups = found.groupBy("group_id").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("shard").alias("a"), F.max("shard").alias("z"))
    even = (found.agg(F.sum("size")).first()[0] or 0) / shards
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("bytes"))), F.lit(0))
    apart = F.col("a") != F.col("z")
    return tuple(groups.where("n > 1").agg(total(F.lit(True)), total(apart), total(apart & (F.col("bytes") <= even / 4))).first())


def quotas(load: np.ndarray, wished: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """How much of ``wished[i, j]``, bytes that want from shard i to shard j, may move so that no shard passes its capacity.

    All wishes are granted first; what comes into a shard beyond its capacity is cut
    in proportion, which lets less leave elsewhere, so cuts repeat until all hold.
    """
    granted = wished.astype(float)
    for _ in range(1000):
        come = granted.sum(axis=0)
        may = np.maximum(0.0, caps - load + granted.sum(axis=1))
        if (come <= may + 0.5).all():
            return granted
        granted = granted * np.minimum(1.0, may / np.maximum(come, 1e-9))
    return granted * 0.0


def propagate(pieces: DataFrame, caps: list[float], rounds: int = ROUNDS) -> DataFrame:
    """Move pieces ``(group_id, origin, shard, bytes, draw, bucket)`` towards the shard that holds most of their group; ``shard`` changes.

    A group has at most one piece per shard it started in.  Of what a round needs only
    the shards' loads and wishes by pair of shards reach the driver.
    """
    shards = len(caps)
    for _ in range(rounds):
        here = pieces.groupBy("group_id", "shard", "draw", "bucket").agg(F.sum("bytes").alias("bytes"))
        wish = here.groupBy(F.col("group_id").alias("g")).agg(F.max_by("shard", F.struct("bytes", F.xxhash64("group_id", "shard"))).alias("wish"))
        met = checkpointed(here.join(wish, F.col("group_id") == F.col("g")).drop("g"))
        load, wished = np.zeros(shards), np.zeros((shards, shards))
        for r in met.groupBy("shard", "wish").agg(F.sum("bytes").alias("b")).collect():
            load[r["shard"]] += r["b"]
            if r["shard"] != r["wish"]:
                wished[r["shard"], r["wish"]] += r["b"]
        granted = quotas(load, wished, np.array(caps))
        if granted.sum() < 1:
            break
        limit = F.get(F.array(*[F.lit(float(x)) for x in granted.ravel()]), F.col("shard") * shards + F.col("wish"))
        line = running(met.where("shard <> wish"), ["shard", "wish"], "bucket", ["draw", "group_id"], F.col("bytes"), "ahead")
        moves = line.where(F.col("ahead") + F.col("bytes") <= limit + 0.5).select(F.col("group_id").alias("g"), F.col("shard").alias("was"), "wish")
        after = pieces.join(moves, (F.col("group_id") == F.col("g")) & (F.col("shard") == F.col("was")), "left")
        after = checkpointed(after.withColumn("moved", F.col("wish").isNotNull()).withColumn("shard", F.coalesce("wish", "shard")).drop("g", "was", "wish"))
        pieces = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    return pieces


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, group_id, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: none); shards come out
    equal in size up to about one document, unless linked documents alone overfill
    some; a group of linked documents lies in one shard unless none has room for it;
    at most ``rounds`` rounds of propagation are run; ``slot`` counts a shard's documents from 0 without gaps.  Null and empty
    texts are one group.  Repeated rows are documents of their own, in the same
    group.  An empty table gives no rows.  Reruns agree.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = checkpointed(docs.select(
        F.col(key).alias("id"), (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.md5(whole.cast("binary")).alias("group_id"), F.xxhash64(F.lit(seed), F.col(key), whole).alias("h")))
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    even = total / shards
    buckets = max(1, -(-count // BUCKET_ROWS))
    sizes = rows.groupBy("group_id").agg(F.count("*").alias("members"), F.sum("size").alias("bytes")).where("members > 1")
    groups = checkpointed(sizes.withColumn("draw", F.xxhash64(F.lit(seed), "group_id")).withColumn("bucket", F.pmod("draw", F.lit(buckets))))
    goal = F.pmod(F.xxhash64(F.lit(seed + 1), "group_id"), F.lit(shards)).cast("int")
    big = groups.where(F.col("bytes") > even / BIG).select("group_id", "bytes", goal.alias("goal")).collect()  # at most BIG for each shard
    spread, loads = _big([tuple(r) for r in big], even, shards)
    lines = rows.sparkSession.createDataFrame([(g, line) for g, line in spread.items()], "group_id string, line array<double>")
    # The others start along the room that the great ones leave, and propagate.
    small = groups.where(F.col("bytes") <= even / BIG)
    linked = small.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    needs = [max(0.0, even - x) for x in loads]
    share = linked / sum(needs) if sum(needs) else 0.0
    start = _along(_unit(F.lit(seed + 1), F.col("id"), F.col("h")) * sum(needs), needs, 1.0)
    rows = checkpointed(rows.withColumn("origin", start))
    votes = rows.groupBy("group_id", "origin").agg(F.sum("size").alias("bytes"))  # before the join: a large group is few rows
    pieces = votes.join(small.select("group_id", "draw", "bucket"), "group_id").withColumn("shard", F.col("origin"))
    moved = propagate(checkpointed(pieces), [max(FULL * n, n * share * 1.005) for n in needs], rounds)
    ends = moved.groupBy("group_id", "draw", "bucket").agg(F.min("shard").alias("a"), F.max("shard").alias("z"), F.sum("bytes").alias("bytes"))
    ends = checkpointed(ends)
    for r in ends.where("a = z").groupBy("a").agg(F.sum("bytes").alias("b")).collect():
        loads[r["a"]] += r["b"]
    needs = [max(0.0, even - x) for x in loads]
    rest = ends.where("a <> z").agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    dealt = running(ends.where("a <> z"), [], "bucket", ["draw", "group_id"], F.col("bytes"), "ahead")
    dealt = dealt.withColumn("a", _along(F.col("ahead") + F.col("bytes") / 2, needs, max(1.0, rest / sum(needs)) if sum(needs) else 0.0))
    whole = ends.where("a = z").select("group_id", F.col("a").alias("shard")).unionByName(dealt.select("group_id", F.col("a").alias("shard")))
    draw = _unit(F.lit(seed), F.col("h"), F.col("id"))
    along = F.least(F.size(F.filter("line", lambda x: x <= draw)), F.lit(shards - 1)).cast("int")
    # Great groups, at most BIG for each shard, are sent to the rows; no other group has more than one in BIG parts of a shard.
    told = rows.drop("origin").join(F.broadcast(lines), "group_id", "left")
    great = told.where("line is not null").withColumn("shard", along).drop("line")
    met = checkpointed(told.where("line is null").drop("line").join(whole, "group_id", "left").unionByName(great))
    linked = met.where("shard is not null")
    loads = {r["shard"]: r["b"] for r in linked.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    needs = [max(0.0, even - loads.get(s, 0)) for s in range(shards)]
    free = total - sum(loads.values())
    lone = met.where("shard is null").withColumn("bucket", F.pmod("h", F.lit(buckets)))
    lone = running(lone, [], "bucket", ["h", "id"], F.col("size"), "ahead")
    lone = lone.withColumn("shard", _along(F.col("ahead") + F.col("size") / 2, needs, free / sum(needs) if sum(needs) else 0.0))
    cols = ["id", "size", "text_crc32", "group_id", "h", "shard"]
    both = lone.select(*cols).unionByName(linked.select(*cols))
    both = both.withColumn("bucket", F.pmod(F.xxhash64("h", "id"), F.lit(max(1, -(-buckets // shards)))))
    out = running(both, ["shard"], "bucket", ["h", "id"], F.lit(1).cast("long"), "slot")
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", "group_id", "shard", "slot")
