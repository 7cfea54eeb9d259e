"""Near-duplicate vectors through navigable small-world graphs, one per shard.

Vectors are hashed into shards; each shard builds a hierarchical navigable
small-world graph.  Every vector is looked up in every shard: a pair of shards
(i, j) searches the vectors of one in the graph of the other.  A task meets some
shards with some others, all pairs of them, so a shard is copied less often than
there are shards.  Shards travel in rows of at most ``PIECE`` vectors, as they are given;
unit vectors in double precision are made from them where a pair needs them.
Beams are widened per graph until an audit against brute force passes.  What a
search finds is verified by cosine in double precision; found links are closed
within the pair (all vectors that one linked part brings together are compared),
so dense groups need no beam as wide as the group.  A task returns link counts
and a spanning forest, never all pairs; forests go to connected components.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lintel.llm.common import attach_by_size, checkpointed, give_back
from lintel.llm.components import Forest, components

THRESHOLD = 0.95
SHARDS = 6              # least number of shards
SHARD_ROWS = 16384      # a shard holds about so many vectors at most
LINKS = 10              # neighbours of a node on upper levels; twice as many on the ground level
BUILD_BEAM = 32
BEAM = 24               # first beam tried; doubled until the audit passes
AUDIT = 200             # audited vectors of a shard (a bound, seeded)
RECALL = 0.98
BATCH = 512
PIECE = 1024            # vectors that travel in one row
SIDE = 4                # shards at most that a task meets with as many others
FEW_SIDES = 8           # a task takes one shard of each side while there are fewer than twice so many
CELLS = 1 << 20         # cosines held at once when all vectors of a linked part are compared
PAIRS = 8192            # found pairs that are verified together


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; the greatest component goes out first, so squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Rows:
    """Unit vectors in double precision, made from the given ones for the rows that are asked for."""

    def __init__(self, given: np.ndarray) -> None:
        self.given = given

    def __len__(self) -> int:
        return len(self.given)

    def __getitem__(self, at) -> np.ndarray:
        return unit(self.given[at].astype(np.float64))


class Graph:
    """A hierarchical navigable small-world graph; searches run for many queries in step.

    ``x`` are unit vectors; ``links[l]`` (nodes, width) hold neighbours on level l,
    -1 where there is none; ``up[l]`` are the nodes of level l, the last level is small
    enough to be scanned.
    """

    def __init__(self, x: np.ndarray) -> None:
        self.x, self.links, self.up, self.beam = x.astype(np.float32), [], [], BEAM

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 1) -> Graph:
        g = cls(x)
        n = len(x)
        level = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int), 8)
        members = [np.nonzero(level >= k)[0] for k in range(int(level.max()) + 1 if n else 0)]
        g.up = [m for m in members if len(m) > 64] or members[:1]
        g.links = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(len(g.up))]
        for k in range(len(g.up) - 1, -1, -1):
            g._level(k)
        return g

    def _level(self, k: int) -> None:
        """Insert the nodes of a level in growing batches; each batch sees the nodes before it and itself."""
        nodes, links = self.up[k], self.links[k]
        higher = set(self.up[k + 1].tolist()) if k + 1 < len(self.up) else set()
        # Nodes that the level above routes to come first, so entries exist.
        nodes = np.array(sorted(nodes.tolist(), key=lambda v: v not in higher), np.int64) if higher else nodes
        done, size = 0, 64
        while done < len(nodes):
            batch = nodes[done:done + size]
            if done == 0:
                found = np.tile(batch, (len(batch), 1))
            else:
                entry = self._descend(self.x[batch], k) if k + 1 < len(self.up) else np.tile(nodes[:4], (len(batch), 1))
                old = self._beam(self.x[batch], k, entry, BUILD_BEAM)[0]
                found = np.concatenate([old, np.tile(batch, (len(batch), 1))], axis=1)
            self._connect(links, batch, found)
            done += len(batch)
            size = min(BATCH, 2 * size)

    def _connect(self, links: np.ndarray, batch: np.ndarray, found: np.ndarray) -> None:
        width = links.shape[1]
        score = np.concatenate([np.einsum("bd,bkd->bk", self.x[batch[lo:lo + 64]], self.x[np.maximum(found[lo:lo + 64], 0)]) for lo in range(0, len(batch), 64)])
        score[(found < 0) | (found == batch[:, None])] = -2
        chosen = self._diverse(found, score, width)
        links[batch] = chosen
        # Back links: a node over its width keeps a diverse choice of old and new neighbours.
        src, dst = np.repeat(batch, width), chosen.reshape(-1)
        ok = dst >= 0
        src, dst = src[ok], dst[ok]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        targets, first, counts = np.unique(dst, return_index=True, return_counts=True)
        most = min(int(counts.max()) if len(counts) else 0, 4 * width)
        if not most:
            return
        cand = np.full((len(targets), width + most), -1, np.int64)
        cand[:, :width] = links[targets]
        place = np.arange(len(dst)) - np.repeat(first, counts)
        keep = place < most
        cand[np.repeat(np.arange(len(targets)), counts)[keep], width + place[keep]] = src[keep]
        for lo in range(0, len(targets), 256):
            t, c = targets[lo:lo + 256], cand[lo:lo + 256]
            s = np.einsum("bd,bkd->bk", self.x[t], self.x[np.maximum(c, 0)])
            s[(c < 0) | (c == t[:, None])] = -2
            links[t] = self._diverse(c, s, width)

    def _diverse(self, cand: np.ndarray, score: np.ndarray, width: int) -> np.ndarray:
        """The usual neighbour choice: nearest first, skipping those nearer to a chosen one; free places filled with the nearest skipped."""
        look = min(cand.shape[1], 3 * width)
        top = np.argpartition(-score, look - 1, axis=1)[:, :look] if look < cand.shape[1] else np.tile(np.arange(look), (len(cand), 1))
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable"), 1)
        c, s = np.take_along_axis(cand, top, 1), np.take_along_axis(score, top, 1)
        out = np.full((len(c), width), -1, np.int64)
        for lo in range(0, len(c), 64):
            cc, ss = c[lo:lo + 64], s[lo:lo + 64]
            v = self.x[np.maximum(cc, 0)]
            among = v @ v.transpose(0, 2, 1)
            valid = ss > -2
            same = (cc[:, :, None] == cc[:, None, :]) & np.tri(look, k=-1, dtype=bool)[None]
            valid &= ~(same & valid[:, None, :]).any(axis=2)
            chosen = np.zeros_like(valid)
            blocked = ~valid
            for j in range(look):
                take = ~blocked[:, j] & (chosen.sum(axis=1) < width)
                chosen[:, j] = take
                blocked |= take[:, None] & (among[:, j, :] > ss)
            rank = np.where(chosen, 0, np.where(valid, 1, 2)) * look + np.arange(look)[None]
            order = np.argsort(rank, axis=1)[:, :width]
            got = np.take_along_axis(cc, order, 1)
            out[lo:lo + 64, : got.shape[1]] = np.where(np.take_along_axis(rank, order, 1) < 2 * look, got, -1)
        return out

    def _descend(self, q: np.ndarray, k: int) -> np.ndarray:
        """Entry nodes for level k: the best of the top level, then one greedy beam per level."""
        top = self.up[-1][:4096]
        score = q @ self.x[top].T
        entry = top[np.argsort(-score, axis=1)[:, :4]]
        for level in range(len(self.up) - 2, k, -1):
            entry = self._beam(q, level, entry, 4)[0]
        return entry

    def _beam(self, q: np.ndarray, k: int, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on a level for all queries in step: ``(nodes, scores)``, best first, -1 pads."""
        links, b = self.links[k], len(q)
        seen = np.zeros((b, len(self.x) + 1), bool)
        row = np.arange(b)[:, None]
        width = max(beam, entry.shape[1])
        ids = np.full((b, width), -1, np.int64)
        score = np.full((b, width), -2, np.float32)
        ids[:, : entry.shape[1]] = entry
        score[:, : entry.shape[1]] = np.where(entry >= 0, np.einsum("bd,bkd->bk", q, self.x[np.maximum(entry, 0)]), -2)
        seen[row, entry] = True
        open_ = ids >= 0
        live = np.arange(b)
        while len(live):
            sc = np.where(open_[live], score[live], -3)
            # Two nodes of every live query are expanded at a time.
            pick = np.argpartition(-sc, 1, axis=1)[:, :2]
            some = np.take_along_axis(sc, pick, 1) > -2.5
            go = some.any(axis=1)
            live, pick, some = live[go], pick[go], some[go]
            if not len(live):
                break
            r = live[:, None]
            at = np.where(some, ids[r, pick], -1)
            open_[r, pick] = False
            new = np.where(at[:, :, None] >= 0, links[np.maximum(at, 0)], -1).reshape(len(live), -1).astype(np.int64)
            new = np.where(seen[r, new], -1, new)
            seen[r, new] = True
            s = np.where(new >= 0, np.einsum("bd,bkd->bk", q[live], self.x[np.maximum(new, 0)]), -2).astype(np.float32)
            # One node may be met through both expanded ones; keep its first place.
            half = new.shape[1] // 2
            twice = (new[:, half:, None] == new[:, None, :half]).any(axis=2) & (new[:, half:] >= 0)
            s[:, half:][twice] = -2
            new[:, half:][twice] = -1
            all_s, all_i = np.concatenate([score[live], s], 1), np.concatenate([ids[live], new], 1)
            all_o = np.concatenate([open_[live], new >= 0], 1)
            best = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
            score[live], ids[live], open_[live] = (np.take_along_axis(v, best, 1) for v in (all_s, all_i, all_o))
        order = np.argsort(-score, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)

    def search(self, q: np.ndarray, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        ids, score = [], []
        for lo in range(0, len(q), BATCH):
            part = q[lo:lo + BATCH]
            i, s = self._beam(part, 0, self._descend(part, 0), beam or self.beam)
            ids.append(i)
            score.append(s)
        return np.concatenate(ids), np.concatenate(score)

    def audit(self, threshold: float, seed: int = 2) -> None:
        """Widen the beam until vectors planted at the threshold find enough of their links.

        A sample of the shard's vectors is disturbed to a cosine at the threshold;
        brute force says which vectors each must find.  Of a vector with more links than half
        the beam so many must be found: what they hang together with is compared exactly later.
        A beam as wide as the shard is as far as widening goes.
        """
        r = np.random.default_rng(seed)
        pick = np.sort(r.permutation(len(self.x))[:AUDIT])
        if len(self.x) < 2:
            return
        base = self.x[pick].astype(np.float64)
        noise = r.standard_normal(base.shape)
        noise -= (noise * base).sum(axis=1, keepdims=True) * base
        norm = np.linalg.norm(noise, axis=1, keepdims=True)
        goal = threshold + 0.002
        q = np.where(norm > 0, goal * base + np.sqrt(1 - goal * goal) * noise / np.maximum(norm, 1e-12), base).astype(np.float32)
        exact = q @ self.x.T >= threshold
        while True:
            ids, score = self.search(q)
            hit = ((score >= threshold) & (ids >= 0)).sum(axis=1)
            must = np.minimum(exact.sum(axis=1), max(1, self.beam // 2))
            if np.minimum(hit, must).sum() >= RECALL * must.sum() or self.beam >= len(self.x):
                return
            self.beam *= 2

    def dump(self) -> bytes:
        """All but the vectors; of the upper levels only the nodes that lie there."""
        out = io.BytesIO()
        np.savez(out, beam=self.beam, n=len(self.up), l0=self.links[0],
                 **{f"l{k}": self.links[k][self.up[k]] for k in range(1, len(self.up))}, **{f"u{k}": self.up[k] for k in range(1, len(self.up))})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes, x: np.ndarray) -> Graph:
        z = np.load(io.BytesIO(data))
        g = cls(x)
        g.beam, g.links, g.up = int(z["beam"]), [z["l0"]], [np.arange(len(x))]
        for k in range(1, int(z["n"])):
            g.up.append(z[f"u{k}"])
            g.links.append(np.full((len(x), LINKS), -1, np.int32))
            g.links[k][g.up[k]] = z[f"l{k}"]
        return g


BUILT = "dim int, shard int, piece int, cls binary, size binary, given binary, graph binary"


def _build(threshold: float):
    """Rows of a shard: in each some of its classes, sizes and vectors, in the first its graph."""
    def run(key, table):
        order = np.argsort(table.column("cls").to_numpy(), kind="stable")
        d, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        given = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks]).reshape(-1, d)[order]
        cls, size = (table.column(c).to_numpy()[order] for c in ("cls", "size"))
        del table
        g = Graph.build(unit(given.astype(np.float64)))
        g.audit(threshold)
        at = range(0, len(cls), PIECE)
        cut = lambda v: pa.array([v[lo:lo + PIECE].tobytes() for lo in at], pa.binary())
        out = pa.table({"dim": pa.array([d] * len(at), pa.int32()), "shard": pa.array([shard] * len(at), pa.int32()), "piece": pa.array(range(len(at)), pa.int32()),
                        "cls": cut(cls), "size": cut(size), "given": cut(given), "graph": pa.array([g.dump(), *[None] * (len(at) - 1)], pa.binary())})
        del g, given
        give_back()
        return out
    return run


def link_pair(a: Graph, xa: np.ndarray | Rows, b: Graph | None, xb: np.ndarray | Rows, wa: np.ndarray, wb: np.ndarray, threshold: float
              ) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links between the vectors of two shards (``b`` None: within one): weighted counts of both sides and a forest.

    Forest ends number the rows of ``a`` first, then those of ``b``.
    """
    within, shift = b is None, 0 if b is None else len(xa)
    forest = Forest()
    for graph, q, x, mirrored in [(a, xa, xa, False)] if within else [(b, xa, xb, False), (a, xb, xa, True)]:
        for lo in range(0, len(q), BATCH):
            part = q[lo:lo + BATCH]
            ids, score = graph.search(part.astype(np.float32))
            row, col = np.nonzero((score >= threshold - 1e-3) & (ids >= 0))
            other = ids[row, col]
            keep = (row + lo != other) | (not within)
            row, other = row[keep], other[keep]
            for at in range(0, len(row), PAIRS):
                i, j = row[at:at + PAIRS], other[at:at + PAIRS]
                sure = (part[i] * x[j]).sum(axis=1) >= threshold
                for u, v in zip((i[sure] + lo).tolist(), j[sure].tolist(), strict=True):
                    forest.union(*((v, shift + u) if mirrored else (u, shift + v)))
    parts: dict[int, list[int]] = {}
    for node in {*forest.up.keys(), *forest.up.values()}:
        parts.setdefault(forest.find(node), []).append(node)
    na, nb, edges = np.zeros(len(xa), np.int64), np.zeros(len(xb), np.int64), []
    done = Forest()
    for part in parts.values():
        part = np.sort(np.array(part))
        left = part if within else part[part < shift]
        right = part if within else part[part >= shift] - shift
        to = xb[right]
        step = max(1, min(1024, CELLS // max(1, len(right))))
        for lo in range(0, len(left), step):
            i = left[lo:lo + step]
            near = xa[i] @ to.T >= threshold
            if within:
                near &= i[:, None] != right[None, :]
            na[i] += near @ wb[right]
            if not within:
                nb[right] += wa[i] @ near
            has = np.nonzero(near.any(axis=1))[0]
            # Each row to its first neighbour, and each column to its first row, connects what the rows share.
            for u, v in [*zip(i[has].tolist(), (right[near[has].argmax(axis=1)] + shift).tolist(), strict=True),
                         *((int(i[near[:, c].argmax()]), int(right[c]) + shift) for c in np.nonzero(near.any(axis=0))[0])]:
                if done.union(u, v):
                    edges.append((u, v))
            # Rows of one block may hang together only through further columns.
            label, ends = (np.array([done.find(u) for u in v.tolist()]) for v in (i, right + shift))
            for r, c in zip(*np.nonzero(near & (label[:, None] != ends)), strict=True):
                if done.union(int(i[r]), int(right[c]) + shift):
                    edges.append((int(i[r]), int(right[c]) + shift))
    return na, nb, edges


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


class Shard:
    """A shard from its rows: the graph, the vectors, classes and sizes."""

    def __init__(self, table: pa.Table, rows: list[int], kind: type) -> None:
        told = lambda c, k: np.concatenate([np.frombuffer(table.column(c)[i].as_buffer(), k) for i in rows])
        self.x = Rows(told("given", kind).reshape(-1, table.column("dim")[0].as_py()))
        self.graph = Graph.load(table.column("graph")[rows[0]].as_buffer(), self.x[:])
        self.cls, self.size = told("cls", np.int64), told("size", np.int64)


def _pair(one: Shard, two: Shard | None, threshold: float) -> pa.Table:
    """Counts (b null) and forest edges (n 0) of a pair of shards, or (``two`` None) within one."""
    other = two or one
    na, nb, edges = link_pair(one.graph, one.x, two and two.graph, other.x, one.size, other.size, threshold)
    names = np.concatenate([one.cls, two.cls]) if two else one.cls
    a, b, n = [], [], []
    for c, k in [(one.cls, na), *([(two.cls, nb)] if two else [])]:
        at = np.nonzero(k)[0]
        a += c[at].tolist()
        b += [None] * len(at)
        n += k[at].tolist()
    for u, v in edges:
        a.append(int(names[u]))
        b.append(int(names[v]))
        n.append(0)
    return pa.table({"a": a, "b": b, "n": n}, schema=FOUND)


def _met(threshold: float, kind: type, side: int):
    """All pairs of the shards of two sides; within a side also each shard alone."""
    def run(key, table):
        shard, piece = (table.column(c).to_numpy() for c in ("shard", "piece"))
        order = np.lexsort((piece, shard))
        rows = {int(s): order[shard[order] == s].tolist() for s in np.unique(shard)}
        lo, hi = (table.column(c)[0].as_py() for c in ("lo", "hi"))
        # One side is held, the shards of the other pass by; a side that is empty meets nothing.
        held = {s: Shard(table, rows[s], kind) for s in rows if s // side == lo}
        found = [_pair(one, None if s == t else held[t], threshold) for s, one in held.items() for t in held if s <= t] if lo == hi else []
        for t in [t for t in rows if t // side != lo] if held else []:
            passing = Shard(table, rows[t], kind)
            found += [_pair(one, passing, threshold) for one in held.values()]
        out = pa.concat_tables([FOUND.empty_table(), *found])
        held = passing = None
        give_back()
        return out
    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    shards: int = SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal length are linked when their cosine in double precision is at
    least ``threshold``; equal vectors are one node of the graphs, with its number
    of copies.  Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing and are their own component.  Null ids count in
    ``n_links`` of others; their component is the least id linked, null if none.
    """
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    # Floats stay floats: half the bytes, and the same doubles later.
    kind = "float" if dict(vectors.dtypes)[vector] == "array<float>" else "double"
    plain = F.transform(vector, lambda v: (v.cast(kind) + F.lit(0.0)).cast(kind))
    rows = vectors.select(F.col(key).alias("id"), F.when(F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda v: v != 0), plain).alias("v"))
    # Equal vectors share a class named by their hash; the vector itself decides.  Outside the shards 128 bits stand for it.
    doubles = F.col("v").cast("array<double>")
    name = F.when(F.col("v").isNotNull(), F.struct(F.xxhash64(doubles).alias("cls"), F.xxhash64(F.lit(2), doubles).alias("check")))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("size")).withColumn("name", name)
    classes = checkpointed(classes.select("name", F.col("name.cls").alias("cls"), "least", "size", "v", F.size("v").alias("dim")))
    total = classes.count()
    n = max(shards, -(-total // shard_rows))
    built = checkpointed(classes.withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "cls"), F.lit(n)).cast("int")).select("dim", "shard", "cls", "size", "v")
                         .groupBy("dim", "shard").applyInArrow(_build(threshold), BUILT))
    # A shard meets every shard, some with some: the task is named by the lesser and the greater number of the two sides.
    side = min(SIDE, max(1, n // FEW_SIDES))
    sides = -(-n // side)
    mine, other = F.floor(F.col("shard") / side).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))
    cells = built.withColumn("other", other).select("*", F.least(mine, "other").alias("lo"), F.greatest(mine, "other").alias("hi")).drop("other")
    tasks = sides * (sides + 1) // 2
    task = F.col("hi") * (F.col("hi") + 1) / 2 + F.col("lo") + F.col("dim")
    met = cells.withColumn("task", F.pmod(task.cast("int"), F.lit(tasks))).repartitionById(tasks, "task").groupBy("task", "dim", "lo", "hi").applyInArrow(
        _met(threshold, np.float32 if kind == "float" else np.float64, side), "a long, b long, n long")
    found = checkpointed(met)
    counts = found.where("b is null").groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null"))
    node = classes.join(counts, F.col("cls") == F.col("of"), "left").join(roots, F.col("cls") == F.col("node"), "left").select(
        "name", "least", "size", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    least = node.groupBy("root").agg(F.min("least").alias("component"))
    node = checkpointed(node.join(least, "root").select(F.col("name").alias("of"), "size", "n_links", "component"))
    out = attach_by_size(rows.select("id", name.alias("name")), node, "name", "of")
    component = F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
