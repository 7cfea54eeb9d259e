"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct word shingles.  Equal sets are folded into one
class first, so copies cost one row each.  Every independent tree starts with all
classes at its root; at a node, the node's own seed chooses one or (with the
probability that makes 1/threshold branches on average) two minwise tokens, and a
class moves to the child its token names.  A pair at the threshold thus keeps one
common node per level in expectation.  Nodes of one member end; nodes small enough
are compared exhaustively, first by signature agreement, then on the full sets of
the members that still have a partner; larger nodes branch on.  What is still
large at the last level (many texts alike) is compared in parts of bounded size, and
so are candidate groups whose sets hold many bytes: each part with a few seeded
members of the whole group first, then what hangs together with the group's main
component only with what does not.  So nothing is dropped, and a group of near
copies costs about one comparison per member.  Verified links go to connected components.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lintel.llm.common import attach_by_size, checkpointed, fresh, word_list
from lintel.llm.components import Forest, components

SHINGLE = 5
THRESHOLD = 80        # percent
TOKENS = 64           # minwise tokens of a signature
TREES = 10
LEVELS = 4
SMALL = 512           # nodes up to so many members are compared at once
LARGE = 4096          # members of a larger node that are compared at once, twice as many where two parts meet
GROUP_BYTES = 64 << 20  # bytes of full sets that are compared at once
SEEDED = 4            # members of a great group that all its parts are compared with
SLACK = 0.2           # signature agreement may lie this much below the threshold (over four standard deviations)

_U = np.uint64
_MIX1, _MIX2, _STEP = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix constants)."""
    x = x + _STEP
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes; keeps a bounded cache of word hashes."""

    CACHE = 200_000

    def __init__(self, width: int) -> None:
        self.width, self.seen = width, {}
        self.odd = mix(np.arange(1, width + 1, dtype=np.uint64)) | _U(1)

    def __call__(self, text: str | None) -> np.ndarray:
        found = word_list(text)
        if not found:
            return np.empty(0, np.uint64)
        seen = self.seen
        if len(seen) > self.CACHE:
            seen.clear()
        try:
            h = np.array([seen[w] for w in found], np.uint64)
        except KeyError:
            for w in found:
                if w not in seen:
                    seen[w] = xxhash.xxh3_64_intdigest(w)
            h = np.array([seen[w] for w in found], np.uint64)
        k = min(self.width, len(h))
        total = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            total += h[i:len(h) - k + 1 + i] * self.odd[i]
        return np.unique(mix(total + _U(k)))


@functools.lru_cache(1)
def _salts() -> np.ndarray:
    return mix(np.arange(1000, 1000 + TOKENS, dtype=np.uint64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set: for each salt, the least hash (32 bits of it)."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    salts = _salts()
    for at in range(0, len(shingles), 4096):
        x = shingles[at:at + 4096, None] ^ salts[None, :]
        x *= _MIX1
        x ^= x >> _U(32)
        x *= _MIX2
        np.minimum(least, x.min(axis=0), out=least)
    return (least >> _U(32)).astype(np.uint32)


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for b in batches:
            n, cls, sig = [], [], []
            for text in b.column("text"):
                s = shingler(text.as_py())
                n.append(len(s))
                cls.append(np.int64(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63).item() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(sig, pa.binary())],
                                             ["id", "key", "n", "cls", "sig"])
    return run


def _branch(level: int, percent: int):
    """Children of (node, class) rows; at level 0 every tree's root."""
    second = 100 / percent - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 4096):
                b = whole.slice(at, 4096)
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, TOKENS) if len(b) else np.empty((0, TOKENS), np.uint32)
                cls = b.column("cls").to_numpy(zero_copy_only=False)
                nodes = [np.full(len(b), r, np.uint64) for r in mix(np.arange(1, TREES + 1, dtype=np.uint64) * _U(7919))] if level == 0 \
                    else [b.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)]
                out_node, out_cls = [], []
                for node in nodes:
                    rows = np.arange(len(b))
                    for c in (1, 2):
                        seed = mix(node ^ mix(np.full(len(b), c, np.uint64)))
                        go = rows if c == 1 else rows[(mix(seed) >> _U(11)).astype(np.float64) / 2**53 < second]
                        token = sig[go, (seed[go] % _U(TOKENS)).astype(np.int64)].astype(np.uint64)
                        out_node.append(mix(seed[go] ^ mix(token)).view(np.int64))
                        out_cls.append(cls[go])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_node)), pa.array(np.concatenate(out_cls))], ["node", "cls"])
    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Runs of equal ``key`` in sorted batches, whole."""
    kept: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero(k[1:] != k[:-1])[0] + 1).tolist(), len(k)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if kept and k[lo] != last:
                yield last, pa.Table.from_batches(kept)
                kept = []
            last = k[lo]
            kept.append(b.slice(lo, hi - lo))
    if kept:
        yield last, pa.Table.from_batches(kept)


def agreeing(sig: np.ndarray, percent: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which signatures hang together by agreement: a label per row, and a spanning forest of row pairs."""
    least = (percent / 100 - SLACK) * TOKENS
    label, edges = np.arange(len(sig)), []
    for i in range(len(sig) - 1):
        # Rows already in the group of i need no second look for grouping.
        rest = np.nonzero(label[i + 1:] != label[i])[0] + i + 1
        if not len(rest):
            continue
        near = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
        if len(near):
            parts, at = np.unique(label[near], return_index=True)
            edges += [(i, j) for j in near[at].tolist()]
            label[np.isin(label, parts)] = label[i]
    return label, edges


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def _partners(percent: int):
    """Members of a node that agree with another one, by candidate group (named by its members, so equal groups of several trees fold)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, members = [], []
        for _, t in _groups(batches, "node"):
            cls = t.column("cls").to_numpy()
            if len(cls) < 2:
                continue
            label, _ = agreeing(_signatures(t.column("sig")), percent)
            for g in np.unique(label):
                who = np.sort(cls[label == g])
                if len(who) > 1:
                    name = xxhash.xxh3_64_intdigest(who.tobytes()) - 2**63
                    names.append(np.full(len(who), name, np.int64))
                    members.append(who)
            if sum(map(len, names)) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names)), pa.array(np.concatenate(members))], ["grp", "cls"])
                names, members = [], []
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names)), pa.array(np.concatenate(members))], ["grp", "cls"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array([shingler(x.as_py()).tobytes() for x in part.column("text")], pa.binary())], ["cls", "items"])
    return run


def links_of(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets: pairs that lie in one linked part already are not compared.

    The sets that agree most with the group's commonest tokens go first: they are
    linked with most others, so few comparisons are left.
    """
    size = np.array([len(x) for x in sets])
    sig = np.stack([signature(x) for x in sets])
    common = np.empty(TOKENS, np.uint32)
    for t in range(TOKENS):
        values, times = np.unique(sig[:, t], return_counts=True)
        common[t] = values[times.argmax()]
    order = np.argsort(-(sig == common).sum(axis=1), kind="stable")
    sig, size = sig[order], size[order]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1].astype(np.int32)
    held = np.zeros(int(flat.max()) + 1, bool)
    label, found = np.arange(len(order)), []
    least = (percent / 100 - SLACK) * TOKENS
    for i in range(len(order) - 1):
        rest = np.nonzero(label[i + 1:] != label[i])[0] + i + 1
        rest = rest[(100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i]))]
        if len(rest):
            rest = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
        if not len(rest):
            continue
        own = flat[first[i]:first[i] + size[i]]
        held[own] = True
        if len(rest) * 4 > len(order):
            shared = np.add.reduceat(held[flat], first, dtype=np.int64)[rest]
        else:
            shared = np.array([int(held[flat[first[j]:first[j] + size[j]]].sum()) for j in rest])
        held[own] = False
        near = rest[100 * shared >= percent * (size[rest] + size[i] - shared)]
        for j in near.tolist():
            if label[j] != label[i]:
                found.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return found


def _verify(percent: int):
    """Links of full sets."""
    def links(t: pa.Table) -> list[tuple[int, int]]:
        return links_of([np.frombuffer(x, np.uint64) for x in t.column("items").to_pylist()], percent)
    return links


def _agree(percent: int):
    """Links of signatures."""
    def links(t: pa.Table) -> list[tuple[int, int]]:
        return agreeing(_signatures(t.column("items")), percent)[1]
    return links


def _linked(members: DataFrame, items: DataFrame, links) -> DataFrame:
    """Links ``a, b`` within every group of ``members`` (``grp, cls``), each group in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in _groups(batches, "grp"):
            cls, found = t.column("cls").to_numpy(), links(t) if len(t) > 1 else []
            if found:
                at = np.array(found)
                yield pa.RecordBatch.from_arrays([pa.array(cls[at[:, 0]]), pa.array(cls[at[:, 1]])], ["a", "b"])
    return members.join(items, "cls").repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def linked(members: DataFrame, items: DataFrame, links, limit: int) -> DataFrame:
    """A forest of the links within every group of ``members`` (``grp, cls, bytes``): no task compares more than about ``limit`` bytes at once.

    A greater group is cut into parts of half the limit.  Each part is compared within, together
    with the group's seeded members.  Members outside the component that then holds most of the
    group's bytes are compared with all members, part against part; two members of that component
    hang together already.  So every link joins two members that share a component at the end.
    """
    seeded = [F.min(F.struct(F.xxhash64(F.lit(k), "cls"), "cls"))["cls"] for k in range(SEEDED)]
    great = checkpointed(members.groupBy("grp").agg(F.sum("bytes").alias("total"), F.array_distinct(F.array(*seeded)).alias("seeded")).where(F.col("total") > limit))
    if great.isEmpty():
        return _linked(members.select("grp", "cls"), items, links)
    parts = lambda size: F.ceil(size * 2 / limit)
    part = lambda count: F.pmod(F.xxhash64("cls"), F.col(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    small = members.join(great, "grp", "left_anti").select("grp", "cls")
    large = checkpointed(members.join(great.select("grp", parts(F.col("total")).alias("parts")), "grp").withColumn("part", part("parts")))
    own = checkpointed(items.join(large.select("cls").distinct(), "cls", "left_semi"))
    led = great.select("grp", every(parts(F.col("total"))).alias("part"), "seeded").select("grp", "part", F.explode("seeded").alias("cls"))
    within = large.select("grp", "part", "cls").unionByName(led).distinct().select(F.xxhash64("grp", "part").alias("grp"), "cls")
    found = checkpointed(_linked(within, own, links))
    named = large.join(components(found), F.col("cls") == F.col("node"), "left").select("grp", "cls", "bytes", "parts", "part", F.coalesce("root", "cls").alias("root"))
    named = checkpointed(named)
    main = named.groupBy("grp", "root").agg(F.sum("bytes").alias("b")).groupBy("grp").agg(F.max(F.struct("b", "root"))["root"].alias("main"), F.sum("b").alias("all"), F.max("b").alias("most"))
    left = main.where(F.col("all") > F.col("most")).select("grp", "main", parts(F.col("all") - F.col("most")).alias("odd_parts"))
    open_ = checkpointed(named.join(left, "grp"))
    odd = open_.where("root <> main").select("grp", part("odd_parts").alias("x"), every(F.col("parts")).alias("y"), "cls")
    all_ = open_.select("grp", every(F.col("odd_parts")).alias("x"), F.col("part").alias("y"), "cls")
    across = odd.unionByName(all_).distinct().select(F.xxhash64(F.lit("across"), "grp", "x", "y").alias("grp"), "cls")
    return found.unionByName(_linked(across, own, links)).unionByName(_linked(small, items, links))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id, kept``.

    Documents are linked when 100 * |A and B| >= ``percent`` * |A or B|;
    ``component_id`` is the least id reachable (its own for a text without words,
    which links with nothing), ``kept`` marks the document that carries it, and
    ``class_id`` names equal sets.  A text shorter than a shingle is one shingle.
    Null ids never become a component id unless all of the component are null.
    Repeated rows are copies of each other.  An empty table gives no rows.
    """
    rows = checkpointed(docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text")).mapInArrow(
        _describe(shingle), f"id {dict(docs.dtypes)[key]}, key long, n long, cls long, sig binary"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))).alias("first")
    classes = checkpointed(rows.where("cls is not null").groupBy("cls").agg(first, F.max("sig").alias("sig"), F.max("n").alias("n"), F.count("*").alias("size"))
                           .select("cls", "first.id", "first.key", "sig", "n", "size"))
    front = classes.select("cls", "sig").mapInArrow(_branch(0, percent), "node long, cls long")
    leaves: list[DataFrame] = []
    crowded = None
    for level in range(1, LEVELS + 1):
        front = checkpointed(front.distinct())
        sizes = front.groupBy("node").agg(F.count("*").alias("cnt")).where("cnt > 1")
        live = checkpointed(front.join(sizes, "node"))
        leaves.append(live.where(F.col("cnt") <= SMALL).select("node", "cls"))
        large = live.where(F.col("cnt") > SMALL)
        if large.isEmpty():
            break
        if level == LEVELS:
            crowded = large.select(F.col("node").alias("grp"), "cls", F.lit(TOKENS * 4).alias("bytes"))
        else:
            front = large.select("node", "cls").join(classes.select("cls", "sig"), "cls").mapInArrow(_branch(level, percent), "node long, cls long")
    leaf = functools.reduce(DataFrame.unionByName, leaves)
    met = leaf.join(classes.select("cls", "sig"), "cls").repartition("node").sortWithinPartitions("node")
    groups = met.mapInArrow(_partners(percent), "grp long, cls long")
    if crowded is not None:
        alike = linked(crowded, classes.select("cls", F.col("sig").alias("items")), _agree(percent), 2 * LARGE * TOKENS * 4)
        groups = groups.unionByName(components(alike).select(F.col("root").alias("grp"), F.col("node").alias("cls")))
    groups = checkpointed(groups.distinct())
    wanted = groups.select("cls").distinct().join(classes.select("cls", "id", "key"), "cls")
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text"))
    fetched = (wanted.withColumnsRenamed({"id": "wid", "key": "wkey"})
               .join(texts, F.col("wid").eqNullSafe(F.col("id")) & (F.col("wkey") == F.col("key"))).select("cls", "text"))
    sets = fetched.dropDuplicates(["cls"]).mapInArrow(_sets(shingle), "cls long, items binary")
    members = groups.join(classes.select("cls", (F.col("n") * 8).alias("bytes")), "cls")
    roots = components(linked(members, sets, _verify(percent), GROUP_BYTES))
    part = checkpointed(classes.select("cls", "id", "size").join(roots, F.col("cls") == F.col("node"), "left").select("cls", "id", "size", F.coalesce("root", "cls").alias("root")))
    names = part.groupBy("root").agg(F.min("id").alias("component_id"))
    where = checkpointed(part.select("cls", "root", "size").join(names, "root").select(F.col("cls").alias("of"), "component_id", "size"))
    out = attach_by_size(rows.select("id", "n", "cls"), where, "cls", "of")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of every near-duplicate component: the one with the least id, then the least hash of its text.

    ``key`` is an integer column.  Rows are told apart by id and text: rows that repeat both
    collapse to one, rows of one id with texts of different components all stay.  Rows without an
    id come after those with one, so they stay unless a document with an id is linked to them.
    """
    own = fresh("own", docs)
    place = F.lpad((F.col(key).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    named = docs.withColumn(own, F.concat(F.coalesce(place, F.lit("9" * 20)), F.lit(":"), F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit(""))))))
    kept = near_duplicates(named, own, text, shingle, percent).where("kept").select(F.col("doc_id").alias("__kept_id")).distinct()
    return named.join(kept, named[own] == kept["__kept_id"], "left_semi").dropDuplicates([own]).select(*[F.col(f"`{c}`") for c in docs.columns])
