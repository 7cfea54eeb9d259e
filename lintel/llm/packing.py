"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenized inside tasks; a document's ids are cut at every full
sequence, and the pieces (whole sequences and one rest per document) are dealt at
random into groups that pack independently.  Only piece metadata is shuffled,
unless the ids themselves are asked for.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import zlib
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lintel.llm.common import releasing

CAPACITY = 2048
GROUP_DOCUMENTS = 8192     # documents dealt to a group, on average
CHUNK_PIECES = 65536       # a group packs in chunks of at most so many pieces
CHUNK_BYTES = 48 << 20     # and, when ids travel along, of at most so many bytes of them
CACHE_BYTES = 384 << 20    # estimated size at which a worker forgets encoded words
CACHE_WITH_IDS = 96 << 20  # the same where the worker also holds ids
ENTRY_BYTES = 200          # dictionary slot and object headers of one remembered word
END = 1
LETTERS = 0x250            # letters below are Latin: the rules' first step (NFC) leaves them alone, and all versions of Unicode class them alike
LAST = chr(LETTERS)
# The rules under which a word of letters stays whole: lower case, then stretches of letters, then names of bytes.
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


class Tokens:
    """Token ids of a text; words are encoded once and kept in a bounded cache.

    With the rules ``NORMAL`` and ``CUT`` in its file the tokenizer drops white space
    and encodes each stretch between white space on its own, so a text's ids are those
    of its words in order, and words of plain letters can go straight to its model.
    Texts that hold ``<|`` may name special tokens; these, and all texts under other
    rules, are encoded whole.
    """

    def __init__(self, path: str, budget: int = CACHE_BYTES) -> None:
        from tokenizers import Tokenizer
        self.model, self.known = Tokenizer.from_file(path), {}
        self.budget, self.held = budget, 0
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.whole, self.names = None, {}
        if rules["normalizer"] == NORMAL and rules["pre_tokenizer"] == CUT and all(w["special"] and not w["normalized"] for w in rules["added_tokens"]):
            self.whole = self.model.model.tokenize
            # What the model reads for a letter: the rules' own names of its bytes.
            self.names = {i: self.model.pre_tokenizer.pre_tokenize_str(chr(i))[0][0] for i in range(128, LETTERS) if chr(i).isalpha()}

    def _plain(self, word: str) -> bool:
        """Whether the rules leave this lower-case word whole."""
        return word.isalpha() and word.islower() and (word.isascii() or max(word) < LAST)

    def _encode(self, found: list[str]) -> list[bytes]:
        """Ids of each lower-case string, as bytes."""
        plain = list(map(self._plain, found))
        flat, cuts = [], [0]
        for w, ok in zip(found, plain, strict=True):
            if ok:
                flat += [t.id for t in self.whole(w if w.isascii() else w.translate(self.names))]
                cuts.append(len(flat))
        ids = np.array(flat, "<u4").tobytes()
        easy = (ids[4 * a:4 * b] for a, b in itertools.pairwise(cuts))
        others = iter(self._lines([w for w, ok in zip(found, plain, strict=True) if not ok]))
        return [next(easy if ok else others) for ok in plain]

    def _lines(self, found: list[str]) -> list[bytes]:
        """Ids of any strings, as bytes: they are encoded as the lines of one text, whose offsets tell the lines apart."""
        if not found:
            return []
        whole = self.model.encode("\n".join(found), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        line = np.searchsorted(ends, np.fromiter((o[0] for o in whole.offsets), np.int64, len(whole.offsets)), "right")
        cuts = [0, *(4 * np.cumsum(np.bincount(line, minlength=len(found)))).tolist()]
        ids = np.array(whole.ids, "<u4").tobytes()
        return [ids[a:b] for a, b in itertools.pairwise(cuts)]

    def _learn(self, words: set[bytes]) -> None:
        # A run of marks after a letter or digit is a token run of its own, so stems are shared; letter case is dropped.
        known, new, joined = self.known, {}, []
        for w in words:
            text = w.decode()
            stem = text.rstrip(SIGNS)
            if stem and (low := stem.lower()) and ((stem.isascii() and stem[-1].isalnum()) or self._plain(low)):
                if low == text:
                    new[w] = text
                    continue
                first, tail = low.encode(), text[len(stem):].encode()
                joined.append((w, first, tail))
                if first not in known:
                    new[first] = low
                if tail and tail not in known:
                    new[tail] = text[len(stem):]
            else:
                new[w] = text
        known.update(zip(new, self._encode(list(new.values())), strict=True))
        for w, first, tail in joined:
            known[w] = known[first] + known[tail] if tail else known[first]
        self.held += sum(ENTRY_BYTES + len(w) + len(known[w]) for w in itertools.chain(new, (j[0] for j in joined)))

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.array([END], np.uint32)
        if self.whole is None or "<|" in text:
            return np.array([*self.model.encode(text, add_special_tokens=False).ids, END], np.uint32)
        if self.held > self.budget:
            self.known.clear()
            self.held = 0
        found, known = (text.lower() if text.isascii() else text).encode("utf-8", "surrogatepass").split(), self.known
        got = list(map(known.get, found))
        if None in got:
            places = [i for i, ids in enumerate(got) if ids is None]
            self._learn({found[i] for i in places})
            for i in places:
                got[i] = known[found[i]]
        return np.frombuffer(b"".join(got) + END.to_bytes(4, "little"), "<u4")


@functools.lru_cache(2)
def tokens_of(path: str, budget: int = CACHE_BYTES) -> Tokens:
    """One encoder per worker process: its cache serves all tasks that the worker runs.

    Tasks are parallel already, so the library's own threads stay off.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokens(path, budget)


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path, CACHE_WITH_IDS if with_ids else CACHE_BYTES)
        for whole in batches:
            for at in range(0, len(whole), 512):
                b = whole.slice(at, 512)
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for i, text in enumerate(b.column("text")):
                    t = tokens(text.as_py())
                    for s in range(0, len(t), capacity):
                        part = t[s:s + capacity]
                        row.append(i)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        total.append(len(t))
                        if with_ids:
                            ids.append(part.tobytes())
                take = pa.array(row, pa.int64())
                cols = [b.column("id").take(take), b.column("grp").take(take), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]]
                names = ["id", "grp", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
    return releasing(run)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of every piece: in falling length, each goes to the first bin with room.

    Leaves of the tournament tree hold the room of each bin and inner nodes the most
    room below them, so the first bin with room is found from the root in log steps.
    """
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int((lengths >= capacity).sum())  # each fills a bin of its own
    bins[order[:full]], offsets[order[:full]] = np.arange(full), 0
    rest = order[full:].tolist()
    leaves = 1
    while leaves < max(1, len(rest)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    size = lengths.tolist()
    for i in rest:
        need, at = size[i], 1
        while at < leaves:
            at *= 2
            if room[at] < need:
                at += 1
        bins[i], offsets[i] = full + at - leaves, capacity - room[at]
        room[at] -= need
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
    return bins, offsets


def _readable(b: pa.RecordBatch) -> pa.RecordBatch:
    """Ids as lists of numbers; until here they travel as little-endian unsigned 32-bit bytes."""
    if "ids" not in b.schema.names:
        return b
    at = b.schema.get_field_index("ids")
    parts = b.column(at).to_pylist()
    flat = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(p) // 4 for p in parts]]), pa.int32()), pa.array(flat))
    return b.set_column(at, "ids", lists)


def _pack(capacity: int, names: list[str]):
    """Packs sorted runs of pieces of one group, chunk by chunk; memory is bounded by the chunk whatever the group."""
    def flush(kept: list[pa.RecordBatch], grp: int, first: int) -> Generator[pa.RecordBatch, None, int]:
        t = pa.Table.from_batches(kept)   # of the batches themselves: no second copy of a chunk is made, and ids turn into lists batch by batch
        bins, offsets = first_fit_decreasing(t.column("length").to_numpy(), capacity)
        t = t.append_column("sequence_id", pa.array(grp * 2**32 + first + bins)).append_column("offset", pa.array(offsets))
        yield from map(_readable, t.select(names).to_batches(max_chunksize=1024 if "ids" in names else None))
        return first + (int(bins.max()) + 1 if len(bins) else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, size, grp, first = [], 0, 0, None, 0
        with_ids = "ids" in names
        tokens_of.cache_clear()           # all ids are made by now; the encoder's words would stay in this worker
        for b in batches:
            if not len(b):
                continue
            g = b.column("grp").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.nonzero(g[1:] != g[:-1])[0] + 1).tolist(), len(g)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                bulk = 4 * sum(b.column("length")[lo:hi].to_pylist()) if with_ids else 0
                if kept and (g[lo] != grp or held + hi - lo > CHUNK_PIECES or size + bulk > CHUNK_BYTES):
                    first = yield from flush(kept, grp, first)
                    kept, held, size = [], 0, 0
                first = first if g[lo] == grp else 0
                grp = int(g[lo])
                kept.append(b.slice(lo, hi - lo))
                held += hi - lo
                size += bulk
        if kept:
            yield from flush(kept, grp, first)
    return releasing(run)


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = True,
         group_documents: int = GROUP_DOCUMENTS, seed: int = 3) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, ``with_ids``, ``ids``.

    ``start`` is the piece's place among its document's ids, ``offset`` its place in
    the sequence; a sequence's pieces lie gapless from 0.  Null text is empty: its one
    id is the end.  Ids, repeated rows and nulls are carried as they are; every input
    row is packed on its own.  An empty table gives no rows.  ``tokenizer`` is a
    tokenizer file at the same path on every machine.
    """
    groups = max(1, -(-docs.count() // group_documents))
    deal = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(F.col(text))), F.lit(groups))
    kind = dict(docs.dtypes)[key]
    cols = "start long, length long, ids_crc32 long, doc_tokens long"
    pieces = docs.select(F.col(key).alias("id"), deal.alias("grp"), F.col(text).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, with_ids), f"id {kind}, grp long, {cols}{', ids binary' if with_ids else ''}")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else []), "sequence_id", "offset"]
    # One group a task: by hash several would meet in one, and their ids are sorted there.
    packed = pieces.repartitionById(groups, F.col("grp").cast("int")).sortWithinPartitions("grp", F.desc("length"), "id", "start", "ids_crc32").mapInArrow(
        _pack(capacity, names), f"id {kind}, {cols}{', ids array<int>' if with_ids else ''}, sequence_id long, offset long")
    return packed.withColumnRenamed("id", "doc_id")
