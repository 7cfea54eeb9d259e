"""Connected components by randomised contraction, all in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lintel.llm.common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that ``edges`` name; nodes are longs.

    Each round every node points at the neighbour (or itself) with the most links,
    ties by a hash that changes with the round; edges move to the nodes pointed at,
    and loops and repeats go.  Stars end in one round, chains shrink by a constant
    factor a round, and a large star only meets map-side aggregates and joins that
    can be split.
    Null ends are ignored; an empty edge table gives an empty result.
    """
    # Written first: making the edges may be costly, and they are read three times.
    pairs = checkpointed(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).dropna())
    loops = pairs.where("a = b").select("a")
    pairs = pairs.where("a <> b")
    left = checkpointed(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        seed = len(steps)
        rank = lambda d, c: F.struct((-F.col(d)).alias("d"), F.xxhash64(F.lit(seed), F.col(c)).alias("h"), F.col(c).alias("v"))
        degree = left.groupBy("a").agg(F.count("*").alias("d"))
        step = checkpointed(
            left.join(degree.withColumnsRenamed({"a": "b", "d": "db"}), "b").groupBy("a").agg(F.count("*").alias("d"), F.min(rank("db", "b")).alias("m"))
            .select(F.col("a").alias("node"), F.least("m", rank("d", "a"))["v"].alias("to")))
        steps.append(step)
        ends = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        left = checkpointed(
            left.join(step.withColumnRenamed("node", "a").withColumnRenamed("to", "ta"), "a").join(ends, "b")
            .where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct())
    if not steps:
        return loops.distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    # Later steps are smaller: compose them from the last to the first.
    root = steps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        onward = root.select(F.col("node").alias("to"), "root")
        root = step.join(onward, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    root = checkpointed(root)
    lone = loops.distinct().join(root, F.col("a") == F.col("node"), "left_anti")
    return root.unionByName(lone.select(F.col("a").alias("node"), F.col("a").alias("root")))


class Forest:
    """Union-find inside one task; the smaller label becomes the root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up, top = self.up, x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            after = up.get(x, x)
            up[x] = top
            x = after
        return top

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True
