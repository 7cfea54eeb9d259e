"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a word's prefix is the encoding of a shorter prefix followed by one
token, and that last token is unique: it ends the prefix, and it can stand after
the shorter prefix's own last token.  So one token per prefix is stored:

* a suffix automaton of the vocabulary reads the word symbol by symbol and knows,
  at each prefix, every token that ends there;
* a pair test says whether two tokens can stand side by side, that is, whether
  the merges that built them would never have joined a piece at the end of the
  left one with a piece at the start of the right one.

Following the stored tokens back from the end of the word gives the ids; they are
those of the merge loop, whatever the word's length, in linear time.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lintel.llm.common import fresh

CACHE_BYTES = 96 << 20     # estimated size at which a worker forgets the words it has encoded
ENTRY_BYTES = 200          # dictionary slot and object headers of one remembered word
PAIRS = 1 << 20            # pair tests remembered
ROWS = 512                 # rows handled and passed on together

# The vocabulary's rule for cutting words, and what it does to lower-case ASCII letters, digits and marks.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[!-/:-@\\[-`{-~]+")


class Vocabulary:
    """Tokens as sequences of symbols, and the merges that built them.

    A symbol is a byte, or a byte that ends a word.  ``parts[t]`` are the two tokens
    merged into ``t`` (None for a symbol), ``step[a, b]`` the place of a merge among all merges.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: special tokens must be matched as they are written")
        self.ids, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in added}
        self.texts = {i: t for t, i in (self.ids | self.special).items()}
        self.step: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.ends: tuple[dict, dict] = {}, {}     # at most one entry per token
        for k, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b, joined = self.ids[left], self.ids[right], self.ids[left + right]
            if joined in self.parts:
                raise ValueError(f"{path}: token {joined} is the result of two merges")
            self.step[a, b], self.parts[joined] = k, (a, b)

    def symbols(self, token: int) -> list[int]:
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if t in self.parts:
                todo.extend(reversed(self.parts[t]))
            else:
                out.append(t)
        return out

    def _pieces(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Pieces that stand at one end of a token while it is built: ``(piece, step that makes it, step that uses it up)``."""
        out = self.ends[side].get(token)
        if out is None:
            out, piece, until = [], token, len(self.step)
            while piece in self.parts:
                made = self.step[self.parts[piece]]
                out.append((piece, made, until))
                piece, until = self.parts[piece][side], made
            out.append((piece, -1, until))
            self.ends[side][token] = out
        return out

    def can_meet(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` can stand side by side in an encoding.

        They cannot if some merge joins a piece at the end of the one with a piece at
        the start of the other while both exist.  Of equal merges the leftmost comes
        first: the inside of ``left`` goes before the border, the border before ``right``.
        """
        for a, a_made, a_used in self._pieces(left, 1):
            for b, b_made, b_used in self._pieces(right, 0):
                k = self.step.get((a, b))
                if k is not None and a_made < k < a_used and b_made < k <= b_used:
                    return False
        return True


class SuffixAutomaton:
    """All substrings of the tokens; from a state, the tokens that end the string read.

    ``go[state * width + symbol]`` is the next state, ``link`` the state of the longest
    suffix outside a state's class, ``longest`` the longest string of the class.  From
    ``first[state]`` on, ``token_length`` and ``token`` list all tokens that end a state's
    longest string, longest first: those of its class, then those along its links,
    down to a single symbol.
    """

    def __init__(self, tokens: dict[int, list[int]], width: int) -> None:
        self.width = width
        self.go: dict[int, int] = {}
        self.link, self.longest = [-1], [0]
        out: list[list[int]] = [[]]     # symbols that leave a state
        for token in tokens:
            last = 0
            for s in tokens[token]:
                last = self._extend(out, last, s)
        own: dict[int, list[tuple[int, int]]] = {}
        for token, symbols in tokens.items():
            state = 0
            for s in symbols:
                state = self.go[state * width + s]
            own.setdefault(state, []).append((len(symbols), token))
        ending: list[list[tuple[int, int]]] = [[]] * len(self.link)
        for state in np.argsort(self.longest, kind="stable").tolist()[1:]:
            rest = ending[self.link[state]]
            ending[state] = sorted(own[state], reverse=True) + rest if state in own else rest
        # As arrays: the steps sorted by key, and all lists of tokens one after the other.
        self.steps = np.sort(np.fromiter(self.go, np.int64, len(self.go)))
        self.targets = np.array([self.go[k] for k in self.steps.tolist()], np.int32)
        self.links, self.lengths = np.array(self.link, np.int32), np.array(self.longest, np.int32)
        self.first = np.cumsum([0, *map(len, ending)])[:-1]
        self.token_length = np.array([n for found in ending for n, _ in found], np.int32)
        self.token = np.array([t for found in ending for _, t in found], np.int32)
        del self.go, self.link, self.longest

    def _split(self, out: list[list[int]], p: int, q: int, s: int) -> int:
        """A state for the strings of ``q`` that a step from ``p`` gives; longer strings stay in ``q``."""
        clone = len(self.link)
        self.link.append(self.link[q])
        self.longest.append(self.longest[p] + 1)
        out.append(list(out[q]))
        for x in out[q]:
            self.go[clone * self.width + x] = self.go[q * self.width + x]
        while p >= 0 and self.go.get(p * self.width + s) == q:
            self.go[p * self.width + s] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, out: list[list[int]], last: int, s: int) -> int:
        q = self.go.get(last * self.width + s)
        if q is not None:
            return q if self.longest[q] == self.longest[last] + 1 else self._split(out, last, q, s)
        new = len(self.link)
        self.link.append(0)
        self.longest.append(self.longest[last] + 1)
        out.append([])
        p = last
        while p >= 0 and p * self.width + s not in self.go:
            self.go[p * self.width + s] = new
            out[p].append(s)
            p = self.link[p]
        if p >= 0:
            q = self.go[p * self.width + s]
            self.link[new] = q if self.longest[q] == self.longest[p] + 1 else self._split(out, p, q, s)
        return new


class Encoder:
    """Ids of texts; words and pieces met before are kept up to a bound in bytes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.vocabulary = v = Vocabulary(path)
        rules = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The usual rules are known in their ASCII part, where no library call is needed.
        self.plain = any(p.get("pattern", {}).get("Regex") == WORD_RULE for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []))
        self.normalize = rules.normalizer.normalize_str if rules.normalizer else str
        self.cut = rules.pre_tokenizer.pre_tokenize_str
        letters = {ord(t): i for t, i in v.ids.items() if i not in v.parts and len(t) == 1}
        self.symbol, self.last_symbol = np.full((2, max(letters) + 1), -1, np.int64)
        for c, i in letters.items():
            self.symbol[c], self.last_symbol[c] = i, v.ids.get(chr(c) + v.end, i)
        self.width = len(v.ids)
        self.automaton = SuffixAutomaton({t: v.symbols(t) for t in v.ids.values()}, self.width)
        # Results of pair tests by a hash of the pair; a newer pair takes an older one's place.
        self.pair, self.fits = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)
        self.known: dict[bytes, bytes] = {}     # words as written
        self.parts: dict[str, bytes] = {}       # the pieces that words are cut into
        self.held = 0
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None

    def _can_meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left * np.int64(self.width) + right
        slot = (pair * 0x9E3779B1 >> 12) % PAIRS
        new = np.nonzero(self.pair[slot] != pair)[0]
        if len(new):
            for k, p in zip(*[x.tolist() for x in (slot[new], pair[new])], strict=True):
                if self.pair[k] != p:
                    self.pair[k], self.fits[k] = p, self.vocabulary.can_meet(*divmod(p, self.width))
            # Pairs that share a slot are tested one by one.
            out = self.fits[slot]
            for j in np.nonzero(self.pair[slot] != pair)[0].tolist():
                out[j] = self.vocabulary.can_meet(*divmod(int(pair[j]), self.width))
            return out
        return self.fits[slot]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces in the vocabulary's letters for bytes; all are read in step, symbol by symbol."""
        if not pieces:
            return []
        a, n = self.automaton, len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        ends = np.cumsum(sizes)
        letters = np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4")
        symbols = self.symbol[letters]
        symbols[ends - 1] = self.last_symbol[letters[ends - 1]]
        order = np.argsort(-sizes, kind="stable")
        at, sizes = (ends - sizes)[order], sizes[order]     # where a piece starts among all symbols
        last = np.full(len(symbols), -1, np.int64)      # the last token of each prefix, and its length
        size = np.zeros(len(symbols), np.int64)
        state, held = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(int(sizes[0])):
            live = int(np.searchsorted(-sizes, -i, "left"))     # pieces longer than i
            rows = np.arange(live)
            while len(rows):
                key = state[rows] * self.width + symbols[at[rows] + i]
                step = np.minimum(np.searchsorted(a.steps, key), len(a.steps) - 1)
                there = a.steps[step] == key
                state[rows[there]] = a.targets[step[there]]
                rows = rows[~there]
                state[rows] = a.links[state[rows]]
                held[rows] = a.lengths[state[rows]]
            held[:live] += 1
            rows, found = np.arange(live), a.first[state[:live]]
            while len(rows):
                length, token = a.token_length[found], a.token[found]
                before = i - length                     # place of the prefix before the token; -1 is the empty one
                ok = (length <= held[rows]) & (before >= -1)
                test = np.nonzero(ok & (before >= 0))[0]
                ok[test] = self._can_meet(last[at[rows[test]] + before[test]], token[test])
                put = at[rows[ok]] + i
                last[put], size[put] = token[ok], length[ok]
                rows, found = rows[~ok], found[~ok] + 1
        # Back from every piece's end; a token's id goes to the place of its last symbol.
        taken = np.zeros(len(symbols), bool)
        i = ends - 1
        first = ends - sizes[np.argsort(order)]
        while len(i):
            taken[i] = True
            i = i - size[i]
            more = i >= first
            i, first = i[more], first[more]
        ids = last[taken].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(taken)[ends - 1]).tolist()]
        return [ids[lo:hi] for lo, hi in itertools.pairwise(cuts)]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words not met before."""
        parts, cut, normalize, ascii_pieces = self.parts, self.cut, self.normalize, ASCII_PIECES.findall
        cuts, new = [], {}
        for w in words:
            word = w.decode()
            found = ascii_pieces(word.lower()) if self.plain and word.isascii() and word.isprintable() else [p for p, _ in cut(normalize(word))]
            cuts.append(found)
            for p in found:
                if p not in parts:
                    new[p] = None
        parts.update(zip(new, self.encode_pieces(list(new)), strict=True))
        self.known.update(zip(words, [parts[f[0]] if len(f) == 1 else b"".join([parts[p] for p in f]) for f in cuts], strict=True))
        self.held += ENTRY_BYTES * (len(new) + len(words)) + 5 * (sum(map(len, new)) + sum(map(len, words)))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.parts.clear()
            self.held = 0
        # A text as stretches of words; every second one is the special token that stands between two of them.
        cut = [[] if not t else self.marks.split(t) if self.marks and self.marks.search(t) else [t] for t in texts]
        words = [[part.encode().split() if k % 2 == 0 else part for k, part in enumerate(parts)] for parts in cut]
        new = {w for parts in words for found in parts[::2] for w in found if w not in self.known}
        self._learn(list(new))
        known, special = self.known.__getitem__, {t: i.to_bytes(4, "little") for t, i in self.vocabulary.special.items()}
        return [b"".join([b"".join(map(known, part)) if k % 2 == 0 else special[part] for k, part in enumerate(parts)]) for parts in words]


@functools.lru_cache(2)
def encoder_of(path: str) -> Encoder:
    """One encoder per worker process, for all tasks that it runs."""
    return Encoder(path)


def decode_ids(ids: list[int], texts: dict[int, str]) -> str:
    """The tokens' texts joined by one space, as a vocabulary without decoder gives them; unknown ids have none."""
    return " ".join([t for t in map(texts.get, ids) if t is not None])


def _encode(path: str, text: str, outputs: tuple[str, str], decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(path)
        texts = encode.vocabulary.texts
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                b = whole.slice(at, ROWS)
                ids = encode(b.column(text).to_pylist())
                ends = np.cumsum([0, *[len(x) // 4 for x in ids]])
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                cols = [*b.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
                if decoded:
                    cols.append(pa.array([decode_ids(np.frombuffer(x, "<u4").tolist(), texts) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, *outputs[:1 + decoded]])
    return run


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the token ids of every whole text as ``array<int>`` and, if ``decoded``, the text that the ids give back.

    Returns the frame and the names of the new columns (``ids``, ``decoded``).  Null and
    empty texts have no ids.  A special token written in a text is that token.  Rows
    are encoded one by one: repeated rows repeat their results, other columns keep
    names and values, and an empty table stays empty.  ``path`` is a byte-level BPE
    vocabulary file of the tokenizers library, at the same place on every machine.
    """
    names = {n: fresh(n, docs) for n in (("ids", "decoded") if decoded else ("ids",))}
    kinds = {"ids": T.ArrayType(T.IntegerType(), False), "decoded": T.StringType()}
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, kinds[n]) for n, c in names.items()]])
    return docs.mapInArrow(_encode(path, text, tuple(names.values()), decoded), schema), names


def _decode(path: str, ids: str, output: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder_of(path).vocabulary.texts
        for b in batches:
            out = [None if x is None else decode_ids(x, texts) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, output])
    return run


def decode(encoded: DataFrame, path: str, ids: str) -> tuple[DataFrame, str]:
    """``encoded`` with the texts that its ids give back, special tokens included; null ids give null, no ids the empty text."""
    name = fresh("decoded", encoded)
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])
    return encoded.mapInArrow(_decode(path, ids, name), schema), name
