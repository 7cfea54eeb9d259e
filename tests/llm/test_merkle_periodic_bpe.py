"""Merkle manifest, periodic runs and byte-pair encoding against brute force; nulls, ties, repeats, clashing names, empty tables."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lintel.llm")

from lintel.llm import bpe, merkle, periodic, queries  # noqa: E402
from lintel.llm.common import tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, digest string, path int, node string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enter(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars):
    return H(*map(enter, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root, and per node the list of (left, right) sibling texts."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            lo = p // 8 * 8
            paths[i].append(("".join(nodes[lo:p]), "".join(nodes[p + 1:lo + 8])))
        place = [p // 8 for p in place]
        nodes = [H(*nodes[lo:lo + 8]) for lo in range(0, len(nodes), 8)]
    return nodes[0], paths


def manifest_rows(rows):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    subs, langs = {}, sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r[:5])))
        subs[lang] = (mine, *tree([leaf(*r[:5]) for r in mine]))
    root, tops = tree([subs[g][1] for g in langs])
    out = []
    for g, top in zip(langs, tops, strict=True):
        mine, sub, paths = subs[g]
        for r, path in zip(mine, paths, strict=True):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = text.translate(lower)
            node = leaf(r[0], text, *r[2:5])
            for left, right in path + top:
                node = H(left, node, right)
            out.append((r[0], leaf(*r[:5]), sub, root, H(*itertools.chain(*(path + top))), node, node == root))
    return sorted(out, key=repr)


def documents(langs, n=700):
    r = np.random.default_rng(5)
    rows = [(int(i), f"Text {i} ÄÖ " + "Word " * int(r.integers(0, 4)), langs[int(x)], f"s{i % 3}", int(i)) for i, x in enumerate(r.choice(len(langs), n, p=None))]
    rows += [(None, "NULL id", langs[0], None, None), (7, None, langs[0], "s", 1), (7, "", langs[0], "s", 1), (7, "", langs[0], "s", 1), (9, "lone", "zz", None, None)]
    return [(*x, "g", "d", 1, "n") for x in rows]


@pytest.mark.parametrize("langs", [["en"], ["en", None, "é", "", "Z"], [f"l{i:02}" for i in range(70)]], ids=["one", "null", "many"])
def test_merkle_rows(spark, tmp_path, langs):
    rows = documents(langs)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_merkle_proofs(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_rows(rows)


def test_merkle_empty_and_stored_levels(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    none = merkle.build(empty, ["doc_id", "text"])
    assert none.root().count() == 0 and none.proofs().count() == 0
    docs = spark.createDataFrame(documents(["en"], 600), SCHEMA)
    kept = merkle.build(docs, ["doc_id", "text"], store=str(tmp_path / "m"))
    assert [p.rsplit("/", 1)[1] for p in kept.groups.levels] == ["level-0", "level-3"]     # 606 leaves have four levels
    assert spark.read.parquet(kept.groups.levels[0]).selectExpr("max(size(nodes))").first()[0] == merkle.SPAN
    one = merkle.build(docs.limit(1), ["text"]).proofs().first()
    assert one.leaf == one.subroot == one.root and one.path == []


def brute_runs(words, least=24, periods=3):
    n, found = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            part = words[s:s + length]
            if length >= max(least, periods * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [] if text is None else [w.decode() for w in text.encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def run_texts():
    r = np.random.default_rng(2)
    texts = [None, "", " \t\n", "one", "a " * 24, "a " * 23, "A a " * 24, "  x y " * 30, "é ß " * 12 + "end", "x y z " * 7 + "x"]
    for _ in range(120):
        vocabulary = [f"w{i}" for i in range(int(r.integers(1, 6)))]
        parts = [list(r.choice(vocabulary, int(r.integers(1, 12)))) * int(r.integers(1, 9)) for _ in range(int(r.integers(1, 6)))]
        texts.append(" ".join(itertools.chain(*parts)))
    long = " ".join(f"u{i}" for i in range(900))
    return [*texts, f"{long} {long} {long} {long}", texts[20], texts[20]]


def test_runs_in_arrays():
    r = np.random.default_rng(8)
    for trial in range(300):
        codes = r.integers(0, 1 + trial % 3, int(r.integers(0, 90)))
        got = [tuple(x) for x in periodic.find_runs(codes, least=3).tolist()]
        assert got == brute_runs(codes.tolist(), least=3), codes.tolist()


def test_periodic_rows(spark, tmp_path):
    planted = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, t) for i, t in enumerate(run_texts())] + [(i, " ".join(f"p{k}" for k in range(i % 97))) for i in planted] + [(None, "n " * 40), (3, "a b c " * 20)]
    docs = spark.createDataFrame([(*x, "en", "s", 1, "g", "d", 1, "n") for x in rows], SCHEMA).select("*", F.lit(1).alias("w"), F.lit(2).alias("__runs"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((brute_row(*x) for x in rows), key=repr)
    found, name = periodic.periodic_runs(docs)
    assert found.columns[:len(docs.columns)] == docs.columns and found.where(f"size({name['runs']}) > 0").count() > 50
    assert periodic.periodic_runs(docs.limit(0))[0].count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, periods=2)


def test_chunks_of_texts_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(run_texts())], "doc_id long, text string").coalesce(1)
    whole = periodic.periodic_runs(docs)[0].collect()
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 50)
    run = periodic._runs("text", ("a", "b", "c"), 24, 3)
    parts = [r for b in run(iter(docs.toArrow().to_batches())) for r in b.to_pylist()]
    assert [(r[2], [x.asDict() for x in r[3]], r[4]) for r in whole] == [(p["a"], p["b"], p["c"]) for p in parts]


def bpe_texts():
    import random
    r = random.Random(3)
    letters = "abcdeTHE 'sétñßİ日本語́  \t\n12٣½!?<|>_-😀ﬁ\x85\x1c\x00\x7f~`[]^"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(chr(r.randint(0, 127)) for _ in range(r.randint(0, 40))) for _ in range(500)]
    return [*texts, None, "", " ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "a" * 9000, "ab" * 4000, "the" * 3000 + "!" * 501, "It's they'LL we'd 've", texts[0], texts[0]]


def test_bpe_rows(spark, tmp_path):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(tokenizer_path())
    rows = list(enumerate(bpe_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("__ids"), F.lit("x").alias("ids"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in queries.op13_bpe_round_trip(spark, str(tmp_path)).collect()) == want
    ids, name = bpe.encode(docs, tokenizer_path())
    back, text = bpe.decode(ids, tokenizer_path(), name["ids"])
    assert sorted((r.doc_id, sha(r[text])) for r in back.collect()) == [(i, d) for i, _, _, d in want]
    assert bpe.encode(docs.limit(0), tokenizer_path())[0].count() == 0


def test_bpe_forgets_words_and_pairs(monkeypatch):
    texts = [t for t in bpe_texts() if t and len(t) < 100][:300]
    want = bpe.Encoder(tokenizer_path())(texts)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    monkeypatch.setattr(bpe, "PAIRS", 16)
    encode = bpe.Encoder(tokenizer_path())
    assert [encode([t])[0] for t in texts] == want and len(encode.known) < 100


def test_pair_test_agrees_with_the_library():
    from tokenizers import Tokenizer
    model, v = Tokenizer.from_file(tokenizer_path()), bpe.Vocabulary(tokenizer_path())
    r = np.random.default_rng(4)
    ends = [t for t in v.ids if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t.islower()]
    starts = [t for t in v.ids if t.isascii() and t.isalpha() and t.islower()]
    for _ in range(3000):
        a, b = starts[r.integers(len(starts))], ends[r.integers(len(ends))]
        alone = model.encode(a + b[:-4], add_special_tokens=False).ids
        assert (alone == [v.ids[a], v.ids[b]]) == v.can_meet(v.ids[a], v.ids[b]), (a, b)
