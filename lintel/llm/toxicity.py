"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is the sum of its word vector and of hashed character n-gram vectors
(with word-boundary marks), so unseen words that share parts with toxic ones count.
Words of more than ``LONG`` bytes (texts without spaces, joined words) are read as
several inputs that overlap, so that every character n-gram is read.  The network reads windows of ``WINDOW`` words that overlap; the
states of both directions are pooled by attention to one logit per window.  All
windows of a text are scored, and a document's score is a logistic function of the
greatest and the mean window logit.  Training is plain numpy on a bounded sample, in one
task; the driver holds the finished parameters only.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lintel.llm.common import fresh, releasing, remainder, word_list
from lintel.llm.minhash import mix

WINDOW, STRIDE = 64, 48
SIZE = 16                   # of the word and character vectors
HIDDEN = 12                 # of each direction
SLOTS = 1 << 15             # hashed character vectors
LONG = 160                  # longer words, in bytes, are several inputs
PIECE, OVERLAP = 48, 5      # characters of such an input, and those it shares with the next: all n-grams of 6 stay whole
TRAIN_TOXIC, TRAIN_CLEAN = 1200, 2000   # bound on the labelled documents that training reads
PART = 512                  # windows scored in step
GRAMMED = 8192              # words whose character n-grams are listed together
TRAIN_WINDOWS = 2           # windows per document that training reads
SEEN = 4                    # places a word or character slot must be found in to have a vector
EPOCHS, BATCH, RATE, DECAY, DROP = 5, 512, 0.03, 1e-4, 0.3
CUTOFF = 0.3
HELD = (4, 2)               # documents with this crc32 remainder are never trained on
SEED = 6

_U = np.uint64


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def inputs_of(text: str | None) -> list[bytes]:
    """The words of a text, long ones in overlapping pieces."""
    found = word_list(text)
    if all(len(w) <= LONG for w in found):
        return found
    out = []
    for w in found:
        if len(w) <= LONG:
            out.append(w)
            continue
        letters = w.decode("utf-8", "surrogatepass")
        out += [letters[at:at + PIECE].encode("utf-8", "surrogatepass") for at in range(0, max(1, len(letters) - OVERLAP), PIECE - OVERLAP)]
    return out


def grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character 3- to 6-grams of every ``<word>``, word by word, and where each word's slots begin (one more at the end)."""
    marked = [f"<{w.decode('utf-8', 'replace')}>" for w in found]
    flat = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(m) for m in marked], np.int64)
    owner = np.repeat(np.arange(len(marked)), sizes)
    room = np.cumsum(sizes)[owner] - np.arange(len(flat))  # characters from here to the end of the word
    slots, owners, h = [], [], flat
    for n in range(2, 7):
        h = h[: max(0, len(flat) - n + 1)] * _U(1_000_003) + flat[n - 1:]
        if n >= 3:
            ok = room[: len(h)] >= n
            slots.append((mix(h[ok] + _U(n)) % _U(SLOTS)).astype(np.int64))
            owners.append(owner[: len(h)][ok])
    who = np.concatenate(owners)
    return np.concatenate(slots)[np.argsort(who, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(found)))])


def _fold(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1])
    return keys[first], np.add.reduceat(rows[order], first, axis=0)


class Network:
    """Parameters, forward and backward passes.

    Words and character slots that the training windows hold in fewer than
    ``SEEN`` places have no vector: they would only let it learn windows by heart.
    """

    def __init__(self, windows: list[list[bytes]], seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        n = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        times: dict[bytes, int] = {}
        for w in windows:
            for x in set(w):
                times[x] = times.get(x, 0) + 1
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted(w for w, c in times.items() if c >= SEEN))}
        self.use = np.ones(SLOTS, bool)
        if times:
            every, often, held = list(times), np.array(list(times.values()), float), np.zeros(SLOTS)
            for lo in range(0, len(every), GRAMMED):
                slots, at = grams(every[lo:lo + GRAMMED])
                held += np.bincount(slots, np.repeat(often[lo:lo + GRAMMED], np.diff(at)), minlength=SLOTS)
            self.use = held >= SEEN
        self.p = {"word": n(len(self.vocabulary) + 1, SIZE, scale=0.1), "char": n(SLOTS, SIZE, scale=0.1),
                  "v": n(2 * HIDDEN, scale=0.3), "w": n(2 * HIDDEN, scale=0.3), "b": np.zeros(1, np.float32)}
        self.p["word"][0] = 0
        for d in "fb":
            self.p |= {f"W{d}": n(SIZE, 3 * HIDDEN, scale=0.3), f"U{d}": n(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}

    def parts(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers (0: none), used character slots, the word of each, and the weight of a word's character vectors."""
        some = []
        for lo in range(0, max(1, len(found)), GRAMMED):
            slots, at = grams(found[lo:lo + GRAMMED])
            ok = self.use[slots]
            some.append((slots[ok], np.repeat(np.arange(lo, lo + len(at) - 1), np.diff(at))[ok]))
        slots, owner = (np.concatenate(x) for x in zip(*some, strict=True))
        return (np.array([self.vocabulary.get(w, 0) for w in found], np.int64), slots, owner,
                (1 / np.sqrt(1.0 + np.bincount(owner, minlength=len(found)))).astype(np.float32))

    def vectors(self, word: np.ndarray, slots: np.ndarray, owner: np.ndarray, scale: np.ndarray) -> np.ndarray:
        out = np.zeros((len(word), SIZE), np.float32)
        if len(slots):
            who, sums = _fold(owner, self.p["char"][slots])
            out[who] = sums
        return out * scale[:, None] + self.p["word"][word]

    def inputs(self, found: list[bytes]) -> np.ndarray:
        """The input vector of each word; their characters' vectors are held for ``GRAMMED`` words at a time."""
        return np.concatenate([self.vectors(*self.parts(found[lo:lo + GRAMMED])) for lo in range(0, max(1, len(found)), GRAMMED)])

    def states(self, x: np.ndarray, keep: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """Gated recurrent states over projected inputs ``x`` (time, batch, 3 H); padded steps keep the state."""
        u, out = self.p[f"U{d}"], np.empty((*x.shape[:2], HIDDEN), np.float32)
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            g = h @ u
            rz = _sigmoid(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            c = np.tanh(x[t, :, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
            new = h + keep[t] * (1 - z) * (c - h)
            if trace is not None:
                trace.append((t, h, r, z, c, g[:, 2 * HIDDEN:]))
            out[t] = h = new
        return out

    def pool(self, s: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = s @ self.p["v"] + np.where(keep[..., 0] > 0, 0, -1e9)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        m = np.einsum("tb,tbh->bh", a, s)
        return a, m, m @ self.p["w"] + self.p["b"][0]

    def project(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        return {d: vectors @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"}

    def logits(self, at: np.ndarray, projected: dict[str, np.ndarray]) -> np.ndarray:
        """Logits of windows; ``at`` (time, batch) indexes words, -1 pads."""
        out = []
        for lo in range(0, at.shape[1], PART):
            part = at[:, lo:lo + PART]
            keep = (part >= 0)[..., None].astype(np.float32)
            s = np.concatenate([self.states(projected[d][part], keep, d) for d in "fb"], axis=2)
            out.append(self.pool(s, keep)[2])
        return np.concatenate(out) if out else np.empty(0, np.float32)

    def gradients(self, at: np.ndarray, parts: tuple[np.ndarray, ...], y: np.ndarray, weight: np.ndarray) -> dict[str, object]:
        """Gradients of the weighted logistic loss over the windows ``at`` of words with the given parts; of vectors only the rows met."""
        p = self.p
        word, slots, owner, scale = parts
        vec = self.vectors(*parts)
        proj, keep = self.project(vec), (at >= 0)[..., None].astype(np.float32)
        traces: dict[str, list] = {"f": [], "b": []}
        s = np.concatenate([self.states(proj[d][at], keep, d, traces[d]) for d in "fb"], axis=2)
        a, m, logit = self.pool(s, keep)
        dl = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        grad = {"w": m.T @ dl, "b": np.array([dl.sum()], np.float32)}
        dm = dl[:, None] * p["w"]
        da = np.einsum("bh,tbh->tb", dm, s)
        dscore = a * (da - (a * da).sum(axis=0))
        grad["v"] = np.einsum("tb,tbh->h", dscore, s)
        ds = a[..., None] * dm[None] + dscore[..., None] * p["v"]
        dvec = np.zeros_like(vec)
        for k, d in enumerate("fb"):
            u = p[f"U{d}"]
            du, dh = np.zeros_like(u), np.zeros((at.shape[1], HIDDEN), np.float32)
            dx = np.zeros((*at.shape, 3 * HIDDEN), np.float32)
            for t, h, r, z, c, gc in reversed(traces[d]):
                dh = dh + ds[t, :, k * HIDDEN:(k + 1) * HIDDEN]
                go = keep[t] * dh
                dc = go * (1 - z) * (1 - c * c)
                dz = -go * (c - h) * z * (1 - z)
                dr = dc * gc * r * (1 - r)
                dx[t] = np.concatenate([dr, dz, dc], axis=1)
                dg = np.concatenate([dr, dz, dc * r], axis=1)
                du += h.T @ dg
                dh = dh - go * (1 - z) + dg @ u.T
            flat, where = dx.reshape(-1, 3 * HIDDEN), at.reshape(-1)
            flat, where = flat[where >= 0], where[where >= 0]
            dproj = np.zeros((len(word), 3 * HIDDEN), np.float32)
            who, sums = _fold(where, flat)
            dproj[who] = sums
            grad |= {f"U{d}": du, f"W{d}": vec.T @ dproj, f"c{d}": dproj.sum(axis=0)}
            dvec += dproj @ p[f"W{d}"].T
        grad["word"] = _fold(word, dvec)
        if len(slots):
            grad["char"] = _fold(slots, (dvec * scale[:, None])[owner])
        return grad

    def train(self, windows: list[list[bytes]], y: np.ndarray, weight: np.ndarray) -> None:
        """Shuffled batches; Adam for the network, row-wise Adagrad for the vectors."""
        r = np.random.default_rng(SEED)
        names: dict[bytes, int] = {}
        rows = [np.array([names.setdefault(x, len(names)) for x in w]) for w in windows]
        word, slots, owner, scale = self.parts(list(names))
        begin = np.searchsorted(owner, np.arange(len(names) + 1))
        dense = [k for k in self.p if k not in ("word", "char")]
        first, second = ({k: np.zeros_like(self.p[k]) for k in dense} for _ in range(2))
        seen = {k: np.full(self.p[k].shape, 1e-3, np.float32) for k in ("word", "char")}
        step, total = 0, EPOCHS * -(-len(windows) // BATCH)
        for _ in range(EPOCHS):
            order = r.permutation(len(windows))
            for lo in range(0, len(order), BATCH):
                some = order[lo:lo + BATCH]
                at = np.full((WINDOW, len(some)), -1, np.int64)
                for j, i in enumerate(some):
                    at[: len(rows[i]), j] = rows[i]
                used, back = np.unique(at[at >= 0], return_inverse=True)
                at[at >= 0] = back
                sizes = begin[used + 1] - begin[used]
                local = np.repeat(np.arange(len(used)), sizes)
                pick = np.arange(len(local)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin[used], sizes)
                drop = r.random(len(used)) < DROP  # the characters must do without the word's own vector now and then
                grad = self.gradients(at, (np.where(drop, 0, word[used]), slots[pick], local, scale[used]), y[some], weight[some])
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for k in dense:
                    g = np.clip(grad[k], -1, 1)
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.p[k] -= (rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
                for k in ("word", "char"):
                    if k in grad:
                        at_rows, g = grad[k]
                        g = g * len(some) ** 0.5 + DECAY * self.p[k][at_rows]
                        seen[k][at_rows] += g * g
                        self.p[k][at_rows] -= (5 * rate * g / np.sqrt(seen[k][at_rows])).astype(np.float32)
                self.p["word"][0] = 0


def starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows of a text of n words; the last window ends with the text."""
    if n <= WINDOW:
        return np.zeros(1 if n else 0, np.int64)
    s = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    return np.minimum(s, n - WINDOW)


class Scorer:
    """Window logits of texts: ``(greatest, mean)`` per text, 0 windows give (0, 0) and are told apart by the count.

    Memory is bounded whatever the batch: texts are scored about ``WORDS`` words at a time, and of the projected
    words those that came back are kept when there are more than ``CACHE`` of them.
    """

    CACHE = 100_000
    WORDS = 40_000

    def __init__(self, net: Network) -> None:
        self.net, self.names = net, {}
        self.times = np.zeros(0, np.int64)
        self.table = {d: np.empty((0, 3 * HIDDEN), np.float32) for d in "fb"}

    def _forget(self) -> None:
        """Keeps the words that came more than once, at most half as many as the cache holds."""
        used = self.times[:len(self.names)]
        rows = np.flatnonzero(used > 1)
        if len(rows) > self.CACHE // 2:
            rows = np.sort(rows[np.argsort(-used[rows], kind="stable")[:self.CACHE // 2]])
        every = list(self.names)
        self.names = {every[i]: k for k, i in enumerate(rows.tolist())}
        self.times = np.zeros(len(self.times), np.int64)
        for t in self.table.values():
            t[:len(rows)] = t[rows]

    def _numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.names) > self.CACHE:
            self._forget()
        names, old = self.names, len(self.names)
        out = []
        for found in texts:
            try:
                out.append(np.array([names[w] for w in found], np.int64))
            except KeyError:
                out.append(np.array([names.setdefault(w, len(names)) for w in found], np.int64))
        if len(names) > len(self.times):
            room = max(len(names), 2 * len(self.times) if len(names) < self.CACHE else self.CACHE + self.WORDS)
            self.times = np.concatenate([self.times, np.zeros(room - len(self.times), np.int64)])
            for d, t in self.table.items():
                self.table[d] = np.zeros((room, t.shape[1]), t.dtype)  # padded steps read the last row and weigh it by 0, so it must be finite
                self.table[d][:old] = t[:old]
        if len(names) > old:
            new = list(itertools.islice(names, old, None))
            for lo in range(0, len(new), self.WORDS):
                at = slice(old + lo, old + min(len(new), lo + self.WORDS))
                for d, x in self.net.project(self.net.inputs(new[lo:lo + self.WORDS])).items():
                    self.table[d][at] = x
        for x in out:
            np.add.at(self.times, x, 1)
        return out

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count, top, mean = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
        lo = 0
        while lo < len(texts):
            hi, held, some = lo, 0, []
            while hi < len(texts) and held < self.WORDS:
                some.append(inputs_of(texts[hi]))
                held += len(some[-1])
                hi += 1
            numbers = self._numbers(some)
            pad = [np.concatenate([x, np.full(max(0, WINDOW - len(x)), -1)]) for x in numbers]
            first = [starts(len(x)) for x in numbers]
            offset = np.concatenate([[0], np.cumsum([len(x) for x in pad])])
            begin = np.concatenate([f + o for f, o in zip(first, offset[:-1], strict=True)]) if some else np.empty(0, np.int64)
            owner = np.repeat(np.arange(len(some)), [len(f) for f in first])
            if len(begin):
                flat = np.concatenate(pad)
                logit = np.concatenate([self.net.logits(flat[begin[None, k:k + PART].astype(np.int64) + np.arange(WINDOW)[:, None]].astype(np.int64), self.table)
                                        for k in range(0, len(begin), PART)])
                n = np.bincount(owner, minlength=len(some))
                greatest = np.full(len(some), -np.inf)
                np.maximum.at(greatest, owner, logit)
                count[lo:hi] = n
                top[lo:hi] = np.where(n > 0, greatest, 0)
                mean[lo:hi] = np.bincount(owner, logit, minlength=len(some)) / np.maximum(n, 1)
            lo = hi
        return count, top, mean


class Model:
    """A trained network with the document-level weights and the share of toxic labels (the score of a text without words)."""

    def __init__(self, net: Network | None, weights: np.ndarray, prior: float) -> None:
        self.net, self.weights, self.prior = net, weights, prior

    def scores(self, count: np.ndarray, top: np.ndarray, mean: np.ndarray) -> np.ndarray:
        s = _sigmoid(self.weights[0] * top + self.weights[1] * mean + self.weights[2])
        return np.where(count > 0, s, min(self.prior, CUTOFF / 2))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge @ w
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, g)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", trainable: Column | None = None,
        toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> Model:
    """Train on at most ``toxic`` + ``clean`` labelled documents (seeded choice, whole texts' windows sampled).

    ``trainable`` limits the labels by their ``doc_id`` (default: the crc32 remainder
    that is held out is not used).  Weights restore the true share of toxic labels.
    Without both labels present the model scores every text with that share.
    """
    may = trainable if trainable is not None else remainder(F.col("doc_id"), HELD[0]) != HELD[1]
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & may).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = marks.agg(F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)), F.count("*")).first()
    prior = totals[0] / totals[1] if totals[1] else 0.0
    if not 0 < totals[0] < totals[1]:
        return Model(None, np.zeros(3), prior)
    pick = lambda t, n: marks.where(F.col("toxic") == t).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(n)
    chosen = pick(1, toxic).unionByName(pick(0, clean)).select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, y, who = [], [], []
            for i, t, c in zip(b.column("__id").to_pylist(), b.column("text").to_pylist(), b.column("__toxic").to_pylist(), strict=True):
                found = inputs_of(t)
                first = starts(len(found))
                few = np.random.default_rng([SEED, i & 0x7FFFFFFF]).permutation(len(first))[:TRAIN_WINDOWS]
                for s in first[np.sort(few)]:
                    parts.append(b" ".join(found[s:s + WINDOW]))
                    y.append(c)
                    who.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), pa.array(y, pa.int32()), pa.array(who, pa.int64())], ["words", "y", "who"])

    known = docs.select(F.col(key).cast("long").alias("__doc"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("__doc") == F.col("__id")).select(F.col("__id").cast("long").alias("__id"), "text", F.col("__toxic").cast("int").alias("__toxic"))

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("who", "words", "y")), strict=True)), key=lambda r: r[:2])
        y = np.array([r[2] for r in rows], np.float32)
        if len(y) and y.min() < y.max():
            share = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9)).astype(np.float32)
            windows = [r[1].split() for r in rows]
            net = Network(windows)
            net.train(windows, y, share)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])

    # The sample is bounded, so one task trains on all of it and the driver's memory stays free of it.
    done = known.mapInArrow(sample, "words binary, y int, who long").repartition(1).mapInArrow(releasing(trained), "net binary").collect()
    if not done:
        return Model(None, np.zeros(3), prior)
    net = pickle.loads(done[0]["net"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for b in batches:
            n, top, mean = scorer(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__toxic"), pa.array(n), pa.array(top), pa.array(mean)], ["id", "y", "n", "top", "mean"])

    seen = np.array(sorted(tuple(r) for r in known.mapInArrow(releasing(whole), "id long, y int, n long, top double, mean double").where("n > 0").collect()), float)
    yy = seen[:, 1]
    if yy.min() == yy.max():
        return Model(None, np.zeros(3), prior)
    return Model(net, _logistic(seen[:, 3:5], yy, np.where(yy == 1, prior / yy.mean(), (1 - prior) / (1 - yy.mean()))), prior)


def score(docs: DataFrame, model: Model, text: str = "text", name: str | None = None) -> tuple[DataFrame, str]:
    """``docs`` plus a column with the toxicity score (0 to 1) of the whole text; returns the frame and the column's name.

    Every overlapping window of every text is scored; a null text or one without
    words gets a low constant.  Rows are independent: repeated rows score alike.
    """
    name = name or fresh("toxicity", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.net) if model.net is not None else None
        for whole in batches:
            for at in range(0, len(whole), 1024):
                b = whole.slice(at, 1024)
                texts = b.column(text).to_pylist()
                s = model.scores(*scorer(texts)) if scorer else np.full(len(texts), min(model.prior, CUTOFF / 2))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, name])

    return docs.mapInArrow(releasing(run), StructType([*docs.schema.fields, StructField(name, DoubleType())])), name
