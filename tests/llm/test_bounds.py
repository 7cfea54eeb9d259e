"""Bounds that operators keep whatever the table: memory of workers, shuffles, bytes that travel."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lintel.llm")

from lintel.llm import embeddings, lm, packing, quality, toxicity  # noqa: E402
from lintel.llm.common import tokenizer_path  # noqa: E402


def texts_of(n, seed):
    """Texts of 300 words, most of them new ones."""
    r = np.random.default_rng(seed)
    return [" ".join(f"w{x}" for x in r.integers(0, 50, 100)) + " " + " ".join(f"u{x}" for x in r.integers(0, 10**9, 200)) for _ in range(n)]


def test_toxicity_scoring_memory_does_not_follow_the_batch():
    net = toxicity.Network([toxicity.inputs_of(t)[:64] for t in texts_of(20, 1)])
    texts = texts_of(1200, 2)
    tracemalloc.start()
    try:
        toxicity.Scorer(net)(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 120e6


def test_toxicity_grams_are_listed_in_slices(monkeypatch):
    found = [f"word{i:06d}x".encode() for i in range(60_000)]
    net = toxicity.Network([found[:64]] * toxicity.SEEN)
    tracemalloc.start()
    try:
        net.parts(found)
        many = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        again = toxicity.Network([found])
        least = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert many < 60e6 and least < 60e6   # all at once: over 100 MB each
    some = found[:3000]
    sliced = [net.parts(some), toxicity.Network([some] * 2).use]
    monkeypatch.setattr(toxicity, "GRAMMED", 700)
    other = [net.parts(some), toxicity.Network([some] * 2).use]
    assert all(np.array_equal(x, y) for x, y in zip(sliced[0], other[0], strict=True)) and np.array_equal(sliced[1], other[1])
    assert [len(x) for x in net.parts([])] == [0, 0, 0, 0] and again.use.any()


def test_toxicity_words_forgotten_change_no_score(monkeypatch):
    net = toxicity.Network([toxicity.inputs_of(t)[:64] for t in texts_of(20, 1)])
    texts = [None, "", *texts_of(40, 3), "alone", " ".join(texts_of(30, 4))]
    plain = toxicity.Scorer(net)(texts)
    monkeypatch.setattr(toxicity.Scorer, "CACHE", 500)
    monkeypatch.setattr(toxicity.Scorer, "WORDS", 700)
    few = toxicity.Scorer(net)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(plain, few(texts), strict=True))
    for t in texts_of(40, 5):
        few([t])
        assert len(few.names) <= 500 + 300
    assert all(w in few.names for w in [b"w%d" % i for i in range(50)])


def crowd(n, seed, d=64):
    """Vectors around one, nearly all of them linked with each other."""
    r = np.random.default_rng(seed)
    return embeddings.unit(np.eye(1, d) + 0.012 * r.standard_normal((n, d)))


def test_linked_vectors_are_verified_in_slices():
    a, b = crowd(3000, 1), crowd(3000, 2)
    one, two = embeddings.Graph.build(a), embeddings.Graph.build(b)
    ones = np.ones(3000, np.int64)
    tracemalloc.start()
    try:
        na, nb, edges = embeddings.link_pair(one, a, two, b, ones, ones, 0.95)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6                       # all found pairs at once: over 100 MB
    near = a @ b.T >= 0.95
    assert (na == near.sum(axis=1)).all() and (nb == near.sum(axis=0)).all() and len(edges) == 5999


def test_shards_travel_in_small_rows_without_a_second_copy(spark):
    x = crowd(2500, 3).astype(np.float32)
    rows = spark.createDataFrame([(64, 0, i, 1, v.tolist()) for i, v in enumerate(x)], "dim int, shard int, cls long, size long, v array<float>")
    built = rows.groupBy("dim", "shard").applyInArrow(embeddings._build(0.95), embeddings.BUILT).orderBy("piece").collect()
    assert max(len(r["given"]) for r in built) <= embeddings.PIECE * 64 * 4
    assert np.array_equal(np.frombuffer(b"".join(r["given"] for r in built), np.float32).reshape(-1, 64), x)
    assert sum(len(v) for r in built for v in r if isinstance(v, bytes | bytearray)) < 2500 * (64 * 4 + 16 + 130)   # 950 bytes a vector before


def test_sides_of_several_shards_meet_all_others(spark):
    r = np.random.default_rng(4)
    x = np.concatenate([embeddings.unit(r.standard_normal((1, 16)) + 0.03 * r.standard_normal((12, 16))) for _ in range(30)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embeddings.near_duplicates(frame, shards=35).orderBy("vec_id").collect()   # four shards a side, the last side has three
    near = x @ x.T >= 0.95
    assert [g["n_links"] for g in got] == (near.sum(axis=1) - 1).tolist()
    floats = frame.withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert [g["n_links"] for g in embeddings.near_duplicates(floats, shards=17).orderBy("vec_id").collect()] == [g["n_links"] for g in got]


def test_quality_cutoffs_reach_the_rows_without_a_shuffle(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 9, "en" if i % 2 else None) for i in range(30)], "doc_id long, text string, lang string")
    cuts = spark.createDataFrame([("en", "shout_rate", 0.0), (None, "word_length", 1.0)], "stratum string, rule string, cutoff double")
    seen, col = quality.add_features(docs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quality.verdict(seen, col, cuts, "lang", "kept")
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = out.select("lang", F.col(col["word_length"]).alias("length"), col["base_failed"], "kept").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 30 and all(r["kept"] == (not r[2] and (r["lang"] == "en" or r["length"] <= 1.0)) for r in got)


def test_words_of_letters_meet_the_model_only():
    tokens = packing.Tokens(tokenizer_path())
    whole = lambda t: [*tokens.model.encode(t, add_special_tokens=False).ids, packing.END]
    calls = []
    lines = tokens._lines
    tokens._lines = lambda found: (calls.extend(found), lines(found))[1]
    text = "The thonre, THONRE! élan Élan, ÉLAN... naïve œuvre straße ÆON ŉa ĳs don't it's 12a3 a1. x2 #tag (note) _a_ 'S l'été d'Ys"
    for t in (text, text.encode("ascii", "ignore").decode(), text):
        assert tokens(t).tolist() == whole(t)
    assert calls and not any(w.isalpha() and w.isascii() or w in ("élan", "naïve", "œuvre", "straße") for w in calls)
    r = np.random.default_rng(8)
    letters = [chr(i) for i in range(33, 0x300) if not 127 <= i < 161]
    for extra in ("", "́̊̇", "ΣςАЯİẞﬁ٣𝐀한글"):
        for _ in range(300):
            t = " ".join("".join(r.choice([*letters, *extra], int(r.integers(1, 6)))) for _ in range(12))
            assert "<|" in t or tokens(t).tolist() == whole(t)
    for c in map(chr, range(33, 0x250)):  # every letter alone, before and after others, with a mark, and with each common accent
        t = f"{c} a{c} {c}a {c}. {c}{c}, {c}́ {c}̊ x{c}'s {c}1"
        assert tokens(t).tolist() == whole(t)


def test_other_rules_leave_words_to_the_tokenizer(tmp_path):
    import json
    rules = json.load(open(tokenizer_path(), encoding="utf-8"))
    rules["normalizer"]["normalizers"] = rules["normalizer"]["normalizers"][:2]  # letter case stays
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(rules), encoding="utf-8")
    tokens = packing.Tokens(str(path))
    assert tokens.whole is None
    for t in ("Thonre thonre élan Élan", "ABC abc"):
        assert tokens(t).tolist() == [*tokens.model.encode(t, add_special_tokens=False).ids, packing.END]


def test_context_counts_are_asked_for_once(spark, monkeypatch):
    """Learning and scoring read stored answers; no exchange is run again for either."""
    seen = []
    fit = lm._fit
    monkeypatch.setattr(lm, "_fit", lambda mixer, both: (fit(mixer, both), seen.append(both)))
    monkeypatch.setattr(lm, "CHUNK", 2000)
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(60))) for i in range(60)] + [(60, None), (61, "")]
    assert lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).count() == 62
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_answers_of_a_chunk_stay_whole():
    import pyarrow as pa
    r = np.random.default_rng(2)
    context = np.sort(r.choice(10**12, 500, replace=False))
    counts = [r.integers(0, 2**32, int(n), dtype=np.uint32) for n in r.integers(0, 9, 500)]
    own = [(5, None, None, b"a"), (5, None, None, b"b"), (6, None, None, b"c")]
    told = [(5, int(c), x.tobytes(), None) for c, x in zip(context, counts, strict=True)]
    t = pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*own[:2], *told, own[2], strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                             ["chunk", "context", "counts", "symbols"])
    out = pa.Table.from_batches(list(lm._gathered(iter(t.to_batches(max_chunksize=90)))))
    assert out.column("symbols").to_pylist() == [b"a", b"b", b"c"]
    got = lm._told(out.slice(0, 2))
    assert (got[0] == context).all() and (got[1] == np.concatenate(counts)).all()
    assert [len(x) for x in lm._told(out.slice(2))] == [0, 0]


def test_pairs_of_context_and_symbol_travel_in_few_bytes():
    import zlib

    import pyarrow as pa
    r = np.random.default_rng(8)
    texts = [np.minimum(r.zipf(1.3, 6000), 3999).astype(np.int64) for _ in range(6)]
    code = lm.Code.build([(b"%d" % i, 1 + 400_000 // i) for i in range(1, 4000)], 1, 4_000_000)
    rows = pa.table({"chunk": np.arange(6) // 2, "symbols": [zlib.compress(s.astype(np.int32).tobytes()) for s in texts], "train": [True] * 5 + [False]})
    asks = pa.Table.from_batches(list(lm._counted(0)(iter(rows.to_batches())))).sort_by([("context", "ascending"), ("chunk", "ascending")]).combine_chunks()
    told = pa.Table.from_batches(list(lm._answered(code)(iter(asks.to_batches()))))
    pairs = sum(len(set(zip(*[x.tolist() for x in lm.contexts(texts[k:k + 2], 0)], strict=True))) for k in (0, 2, 4))
    assert asks.nbytes < 5 * pairs and told.nbytes < 8 * pairs   # 31 and 38 bytes a pair before, 2 and 3 after


@pytest.mark.parametrize("slice_", [500_000, 40])
def test_large_counts_come_back_exact(monkeypatch, slice_):
    """Counts beyond a byte, and beyond 16 bits scaled as before; pairs summed at once and in slices; pairs that training does not hold."""
    import zlib

    import pyarrow as pa
    monkeypatch.setattr(lm, "SLICE", slice_)
    r = np.random.default_rng(9)
    texts = [np.minimum(r.geometric(0.4, 50_000) - 1, 40).astype(np.int64) for _ in range(5)] + [r.integers(0, 41, 300).astype(np.int64)]
    code = lm.Code.build([(b"" if i == 1 else b"%d" % i, 1 + 3 ** (12 - i // 4)) for i in range(1, 41)], 5, 10**6)
    end = code.ids[b""]
    rows = pa.table({"chunk": np.arange(6) // 2, "symbols": [zlib.compress(s.astype(np.int32).tobytes()) for s in texts], "train": [True] * 5 + [False]})
    asks = pa.Table.from_batches(list(lm._counted(end)(iter(rows.to_batches())))).sort_by([("context", "ascending"), ("chunk", "ascending")]).combine_chunks()
    told = pa.Table.from_batches(list(lm._answered(code)(iter(asks.to_batches(max_chunksize=4))))).to_pylist()
    context, symbol = (np.concatenate(x) for x in zip(*[lm.contexts([s], end) for s in texts[:5]], strict=True))
    sizes, _, node, bit = code.paths(symbol)
    names, of = np.unique(np.repeat(context, sizes) * code.nodes + node, return_inverse=True)
    counts = np.stack([np.bincount(of, bit == v, len(names)) for v in (0, 1)])
    assert counts.sum(axis=0).max() > 60_000 and (counts > 255).any()
    counts = lm.halved(counts)
    for chunk in range(3):
        both = texts[2 * chunk:2 * chunk + 2]
        own = sorted((t["context"], t["counts"]) for t in told if t["chunk"] == chunk)
        m = lm.Mixer(code, *np.zeros((2, code.size()), np.uint16)).meet(np.array([c for c, _ in own]), np.frombuffer(b"".join(x for _, x in own), np.uint32), both)
        at = np.concatenate(m.places(both))
        context, symbol = lm.contexts(both, end)
        sizes, place, node, _ = code.paths(symbol)
        name = np.repeat(context, sizes) * code.nodes + node
        to = np.minimum(np.searchsorted(names, name), len(names) - 1)
        want = counts[:, to] * (names[to] == name)
        got = np.repeat(at, sizes) + place
        assert (m.zeros[got] == want[0]).all() and (m.ones[got] == want[1]).all()


def test_toxicity_trains_in_a_task_as_on_the_same_windows_here(spark, monkeypatch):
    texts = [t + (" vile" if i % 3 == 0 else " kind") for i, t in enumerate(texts_of(60, 6))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    rows = []
    for i, t in enumerate(texts):
        found = toxicity.inputs_of(t)
        first = toxicity.starts(len(found))
        few = np.random.default_rng([toxicity.SEED, i]).permutation(len(first))[:toxicity.TRAIN_WINDOWS]
        rows += sorted((b" ".join(found[s:s + toxicity.WINDOW]).split() for s in first[few]), key=b" ".join)
    y = np.repeat([float(i % 3 == 0) for i in range(60)], toxicity.TRAIN_WINDOWS).astype(np.float32)
    net = toxicity.Network(rows)
    net.train(rows, y, np.ones(len(y), np.float32))

    def here(*_):
        raise AssertionError("trained in the driver")

    monkeypatch.setattr(toxicity.Network, "train", here)
    got = toxicity.fit(docs, labels, trainable=F.lit(True)).net
    assert got.vocabulary == net.vocabulary and np.array_equal(got.use, net.use)
    assert all(np.allclose(got.p[k], net.p[k], atol=1e-4) for k in net.p)


def test_toxicity_inputs_hold_few_character_vectors(monkeypatch):
    found = [f"word{i:06d}x".encode() for i in range(40_000)]
    net = toxicity.Network([found[:64]] * toxicity.SEEN)
    net.use[:] = True
    tracemalloc.start()
    try:
        net.inputs(found)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6   # all at once: 249 MB
    some = found[:3000]
    sliced = net.inputs(some)
    monkeypatch.setattr(toxicity, "GRAMMED", 700)
    assert np.array_equal(net.inputs(some), sliced) and net.inputs([]).shape == (0, toxicity.SIZE)


def test_toxicity_padded_steps_read_no_left_over_memory(monkeypatch):
    net = toxicity.Network([toxicity.inputs_of(t)[:64] for t in texts_of(20, 1)])
    calls = [texts_of(3, 7), ["alone", "two words"]]   # the second call makes room for more words than it has
    plain = [toxicity.Scorer(net)(t) for t in calls]
    monkeypatch.setattr(np, "empty", lambda shape, dtype=float: np.full(shape, np.nan if np.dtype(dtype).kind == "f" else 0, dtype))
    again = toxicity.Scorer(net)
    for texts, expected in zip(calls, plain, strict=True):
        got = again(texts)
        assert all(np.isfinite(b).all() and np.allclose(a, b, atol=1e-5) for a, b in zip(expected, got, strict=True))


def test_a_task_packs_one_group(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 90)) for i in range(400)], "doc_id long, text string")
    out = packing.pack(docs, tokenizer_path(), group_documents=20)
    got = out.select(F.spark_partition_id().alias("task"), F.shiftright("sequence_id", 32).alias("grp")).distinct().collect()
    assert len(got) == 20 == len({r["task"] for r in got}) == len({r["grp"] for r in got})  # by hash several groups met in one task


def test_packing_holds_a_chunk_once():
    import pyarrow as pa
    packing.tokens_of(tokenizer_path(), packing.CACHE_WITH_IDS)("some words")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]

    def pieces():
        for at in range(0, 5000, 250):   # 41 MB of ids
            whole = [pa.array(x, pa.int64()) for x in (range(at, at + 250), [3] * 250, [0] * 250, [2048] * 250, [0] * 250, [2048] * 250)]
            yield pa.RecordBatch.from_arrays([*whole, pa.array([np.full(2048, i, "<u4").tobytes() for i in range(at, at + 250)], pa.binary())],
                                             ["id", "grp", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    seen, most = 0, 0
    tracemalloc.start()
    for b in packing._pack(2048, names)(pieces()):
        most = tracemalloc.get_traced_memory()[1]
        assert b.column("ids").flatten().to_numpy()[::2048].tolist() == b.column("id").to_pylist() and set(b.column("offset").to_pylist()) == {0}
        assert b.column("sequence_id").to_pylist() == list(range(3 * 2**32 + seen, 3 * 2**32 + seen + len(b)))
        seen += len(b)
        tracemalloc.reset_peak()
        if seen == len(b):
            first = most
    tracemalloc.stop()
    assert seen == 5000 and first < 40e6   # all lists at once, besides the chunk: over 40 MB
    assert packing.tokens_of.cache_info().currsize == 0


def test_a_task_gives_its_memory_back():
    from lintel.llm.common import releasing
    last = []

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    def run(batches):
        held = [bytes(700) for _ in range(200_000)]
        last.append(bytes(700))          # lies above them, so the allocator cannot shrink by itself
        yield from batches
        assert len(held) == 200_000
    list(releasing(lambda batches: batches)(iter("")))   # what earlier tests freed is given back first
    before = resident()
    assert list(releasing(run)(iter("ab"))) == ["a", "b"]
    assert resident() - before < 60e6    # 140 MB stay otherwise
