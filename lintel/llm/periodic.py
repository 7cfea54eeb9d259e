"""Periodic runs of words: a dictionary of basic factors proposes periods.

For every power-of-two length f the dictionary names the factors (stretches of f
words) that occur again in their text.  Where a factor's next occurrence lies d <= f
words on, f words d apart agree.  Occurrences d apart in a chain are an arithmetic
progression of difference d, and progressions that start at neighbouring places
extend one another: a maximal stretch of places s..e whose next occurrence lies d
on is the stretch of words s .. e+d+f-1 of period d, and no neighbour extends it.

Two facts make this exact.  (1) If d <= f, a nearer occurrence of the factor just
left or right of such a stretch would repeat inside the stretch too, so the
stretch ends where the words stop to agree, and d is its smallest period.  (2) A
run of period q and length 3q or more shows whole at the first power of two
f >= q, since f + q < 3q.  So each length f gives the runs with f/2 < d <= f, and
taking no others there removes what the longer factors would find again.
"""

from __future__ import annotations

import collections
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lintel.llm.common import fresh

LEAST_WORDS = 24
LEAST_PERIODS = 3
CHUNK_WORDS = 1 << 17      # texts are taken together up to so many words; a longer text is a chunk of its own

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(codes: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """``(start, length, period)`` rows, by start then period, of all runs in an array of codes.

    Texts can be joined if their codes differ: no factor then occurs in two of them,
    and one that crosses a border occurs once.
    """
    n, f, found = len(codes), 1, []
    rank = np.full(n, -1, np.int64)
    places, key, named = np.arange(n), codes.astype(np.int64), np.empty(0, np.int64)
    while len(places):
        order = np.argsort(key, kind="stable")
        at, by = places[order], key[order]
        same = by[1:] == by[:-1]
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        # Names of the factors that occur again; the others are left out from here on.
        name = np.cumsum(np.concatenate([[False], ~same]))
        rank[named] = -1
        named = at[again]
        rank[named] = name[again]
        gap = at[1:] - at[:-1]
        near = same & (gap <= f) & (2 * gap > f)
        i, d = at[:-1][near], gap[near]
        if len(i):
            sort = np.argsort(i)
            i, d = i[sort], d[sort]
            first = np.concatenate([[True], (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1])])
            s, e = i[first], i[np.concatenate([first[1:], [True]])]
            period = d[first]
            length = e - s + period + f
            ok = length >= np.maximum(least, periods * period)
            found.append(np.stack([s[ok], length[ok], period[ok]], 1))
        places = np.sort(named)
        places = places[places + f < n]
        places = places[rank[places + f] >= 0]
        key = rank[places] * (int(name[-1]) + 1) + rank[places + f]
        f *= 2
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def _runs(text: str, outputs: tuple[str, str, str], least: int, periods: int):
    def chunk(texts: list[list[bytes]]) -> Iterator[tuple[int, list[dict], bytes]]:
        """Number of words, runs and collapsed text of each text."""
        ends = np.cumsum([len(w) for w in texts])
        code: dict[bytes, int] = collections.defaultdict()
        code.default_factory = code.__len__
        codes = np.fromiter((code[w] for words in texts for w in words), np.int64, int(ends[-1]))
        owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        found = find_runs(owner * max(1, len(code)) + codes, least, periods)
        cuts = np.searchsorted(found[:, 0], [0, *ends.tolist()])
        for k, words in enumerate(texts):
            mine = found[cuts[k]:cuts[k + 1]].copy()
            mine[:, 0] -= ends[k] - len(words)
            if len(mine):
                words = [w for w, stays in zip(words, kept_words(len(words), mine).tolist(), strict=True) if stays]
            yield len(texts[k]), [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()], b" ".join(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [(t or b"").split() for t in b.column(text).cast(pa.binary()).to_pylist()]
            lo = 0
            while lo < len(words):
                hi, held = lo + 1, len(words[lo])
                while hi < len(words) and held + len(words[hi]) <= CHUNK_WORDS:
                    held += len(words[hi])
                    hi += 1
                count, found, kept = zip(*chunk(words[lo:hi]), strict=True)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(count, pa.int64()), pa.array(found, pa.list_(RUN)), pa.array(kept, pa.string())], [*part.schema.names, *outputs])
                lo = hi
    return run


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with three more columns, whose names are returned: ``words``, ``runs`` and ``collapsed``.

    ``runs`` lists every maximal stretch of words with smallest period q and at least
    ``max(least, periods * q)`` words as ``(start, length, period)``, by start then
    period; ``collapsed`` joins by one space the words that no run holds after its
    first q words.  Words are compared as they are written.  Null, empty and blank
    texts have no words, no runs and an empty collapsed text; rows are treated one by
    one, so repeated rows and ids repeat their results, and an empty table stays
    empty.  Other columns keep their names and values.  At least three periods are
    needed for the method to be exact.
    """
    if periods < 3:
        raise ValueError("runs of fewer than three periods are not found by this method")
    names = {n: fresh(n, docs) for n in ("words", "runs", "collapsed")}
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    added = zip(names.values(), (T.LongType(), T.ArrayType(run), T.StringType()), strict=True)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, kind) for n, kind in added]])
    return docs.mapInArrow(_runs(text, tuple(names.values()), least, periods), schema), names


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of equal ones the first.  Null where there is none."""
    more = lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a)
    return F.when(F.size(runs) > 0, F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0), more))
