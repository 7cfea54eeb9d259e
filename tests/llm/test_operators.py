"""The training-data operators against brute force on small tables, with nulls, ties, repeats and empty tables."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lintel.llm")

from lintel.llm import embeddings, html_text, lm, minhash, mixing, packing, quality, sharding, toxicity, url_lists  # noqa: E402
from lintel.llm.queries import tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int"


def corpus():
    r = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(r.choice(vocabulary, 60)), "en", f"s{i % 3}"))
    for i in range(60, 80):  # near copies
        words = rows[i - 60][1].split()
        words[5] = "changed"
        rows.append((i, " ".join(words), "de", None))
    rows += [(80, None, None, None), (81, "", "en", "s0"), (82, "a b", "en", "s1"), (83, "A  B", "en", "s1"), (84, "a b\tc", "fr", "s2"), (None, rows[0][1], "en", "s0"),
             (3, rows[3][1], "en", "s0"), (85, "one two three four five " * 40, "en", "s2"), (86, "\n".join(["same line here"] * 4 + ["#$ %&"]), "en", "s2")]
    return [(*x, 7, 1, 2) for x in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set()


def test_near_duplicates(docs, empty):
    rows = corpus()
    sets = [shingles(r[1], 3) for r in rows]
    link = collections.defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                link[i].add(j)
                link[j].add(i)
    want = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids) if ids else None
        want.append((r[0], len(sets[i]), c, r[0] == c))
    got = minhash.near_duplicates(docs, shingle=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept").collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.keep_one(docs, shingle=3, percent=85)
    assert kept.columns == docs.columns and kept.count() == len({w[2] for w in want})


def test_components_of_chains_and_stars(spark):
    from lintel.llm.components import components
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(7, 7), (500, 500)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(got) == 61 + 49 + 1 and len(set(got.values())) == 3 and got[100] == got[160] and got[1] == got[49]


def test_quality_features(docs, spark, empty):
    seen, col = quality.add_features(docs)
    for r in seen.collect():
        w = (r["text"] or "").encode().split()
        g = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        spots = {j for i in range(len(w) - 4) if g[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (r["text"] or "").split("\n") if x.encode().split()]
        assert (r[col["n_words"]], r[col["n_repeat_words"]], r[col["n_dup_lines"]]) == (len(w), len(spots), len(lines) - len(set(lines)))
        assert r[col["n_symbols"]] == sum(c in "#*$%&|<>" for c in r["text"] or "")
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (1, None)], "doc_id long, quality int")
    out, col, kept = quality.assess(docs, labels)
    assert out.count() == docs.count() and out.where(F.col(kept) & F.col(col["base_failed"])).count() == 0
    assert quality.assess(empty, labels)[0].count() == 0


def test_binomial_tail(spark):
    cases = [(0, 600), (3, 1000), (9, 900), (0, 1), (200, 300)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in rows:
        want = sum(math.comb(r["n"], i) * 0.01**i * 0.99**(r["n"] - i) for i in range(r["k"] + 1))
        assert r["p"] == (1.0 if r["k"] > 0.01 * r["n"] else pytest.approx(want, rel=1e-9))


def test_certified_cutoff(spark):
    rows = [("en", i < 3000, 0.001 if i < 3000 else 0.5) for i in range(3200)] + [("de", True, 0.5)] * 5
    labelled = spark.createDataFrame(rows, "lang string, good boolean, rate double")
    got = quality.certify(labelled, {"symbol_rate": "rate"}, "lang", "good").collect()
    assert [(r["stratum"], r["lost_good"], r["caught_bad"]) for r in got] == [("en", 0, 200)]


def test_mixing(docs, empty):
    out = mixing.mix(docs).toPandas()
    sizes = [len((r[1] or "").encode().split()) for r in corpus()]
    assert sorted(out["size"]) == sorted(sizes) and (out.taken <= 2 * out["size"]).all()
    assert abs(out.drop_duplicates("source_size").target.sum() - 1.5 * sum(sizes)) < 1e-6
    whole = mixing.mix(docs, whole_rows=True)
    assert whole.columns == docs.columns
    assert sum(len(r["text"].encode().split()) for r in whole.collect()) == out.taken.sum()
    assert mixing.mix(empty).count() == 0 and mixing.mix(empty, whole_rows=True).count() == 0


def test_budget_is_met_exactly_when_it_can_be():
    lengths, counts = np.array([3, 5, 11]), np.array([100, 40, 9])
    for budget in range(40, 500, 7):
        take = mixing.fit(lengths, counts, budget)
        assert (take * lengths).sum() == budget and (take <= counts).all()


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(tokenizer_path())
    out = packing.pack(docs, tokenizer_path(), capacity=64).toPandas()
    got = collections.Counter()
    for (doc, n), g in out.groupby([out.doc_id.fillna(-1), "doc_tokens"]):
        pass
    want = [[*model.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in corpus()]
    assert out.length.sum() == sum(map(len, want)) and out.groupby("sequence_id").length.sum().max() <= 64
    for r in out.itertuples():
        ids = np.array(r.ids, "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and len(ids) == r.length
        got[(r.start, ids.tobytes())] += 1
    assert got == collections.Counter((s, np.array(w[s:s + 64], "<u4").tobytes()) for w in want for s in range(0, len(w), 64))
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1].tolist()]
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_words_encoded_as_lines_equal_whole_texts():
    tokens = packing.Tokens(tokenizer_path())
    texts = ["", "  ", "a\u0085b\u2028c d\u3000e", "e\u0301 \u00c9 \u0130 \ufb01", "\u200bx", "a\x00b \x1c z", "\u65e5\u672c\u8a9e !!", "x" * 3000 + "!?", "na\u00efve, it's; a-b.", "it's it's"]
    for text in texts:
        assert tokens(text).tolist() == [*tokens.model.encode(text, add_special_tokens=False).ids, packing.END]


def test_first_fit_decreasing_like_a_plain_scan():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 101, 500)
    bins, _ = packing.first_fit_decreasing(lengths, 100)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        k = next((k for k, x in enumerate(room) if x >= lengths[i]), None)
        if k is None:
            room.append(100)
            k = len(room) - 1
        room[k] -= lengths[i]
        assert bins[i] == k


def test_sharding(docs, empty):
    out = sharding.shard(docs, shards=4).toPandas()
    assert len(out) == len(corpus()) and out["size"].sum() == sum(len((r[1] or "").encode()) + 1 for r in corpus())
    assert all(sorted(g) == list(range(len(g))) for _, g in out.groupby("shard").slot)
    assert sharding.shard(empty).count() == 0


@pytest.mark.parametrize("giant", [0, 3000])
def test_copies_stay_together_where_nearly_all_are_copies(spark, giant):
    rows = [(i, f"text {i // 3} " + "x" * (i // 3 % 50)) for i in range(6000)] + [(10_000 + i, f"lone {i}" * 5) for i in range(60)]
    rows += [(20_000 + i, "the one that is everywhere") for i in range(giant)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8)
    linked, apart, small = sharding.cut(out, 8)
    load = out.groupBy("shard").agg(F.sum("size").alias("b")).toPandas().b
    assert out.count() == len(rows) and linked > 0 and small == 0 and (giant or not apart)
    assert len(load) == 8 and load.max() < 1.03 * load.mean() and load.min() > 0.97 * load.mean()


def test_vectors(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((150, 16))
    x = np.concatenate([base, base[:40] + 0.05 * r.standard_normal((40, 16)), base[:10]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, []), (204, [1.0, None])]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas().set_index("vec_id").sort_index()
    assert got.n_links.loc[:199].tolist() == link.sum(1).tolist() and (got.n_links.loc[200:] == 0).all() and got.kept.loc[200:].all()
    label = np.arange(200)
    for _ in range(200):
        label = np.array([min([label[i], *label[link[i]]]) for i in range(200)])
    assert got.component_id.loc[:199].tolist() == label.tolist()
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_url_lists(spark):
    entries = [("domain", "example.com", "block", 1), ("host", "a.example.com", "allow", 5), ("host", "a.example.com", "block", 9), ("url", "a.example.com/x", "allow", 10), ("host", None, "block", 1)]
    captures = [(1, "http://A.example.com/x#f", 0), (2, "https://a.example.com:80/y", 4), (3, "https://a.example.com/x", 6), (4, "http://a.example.com/x", 9), (5, "http://a.example.com/x", 12), (6, None, 3),
                (7, "http://other.org/", 3), (7, "http://other.org/", 3)]
    out = url_lists.filter_urls(spark.createDataFrame(captures, "id long, url string, fetched_at int"), spark.createDataFrame(entries, "kind string, pattern string, action string, effective_at int"))
    assert sorted((r["id"], r["decision"], r["matched_kind"] or "") for r in out.collect()) == [
        (1, "none", ""), (2, "block", "domain"), (3, "allow", "host"), (4, "block", "host"), (5, "allow", "url"), (6, "none", ""), (7, "none", ""), (7, "none", "")]


def test_main_text(spark):
    page = ("<html><head><title>T</title></head><body><nav><a>menu</a></nav><!-- x --><div class='ad'>buy</div><article><h1>A &amp; B</h1><p>one\n two<p>three<script>x='</p>'</script>"
            "<div class='comments'><p>reader</p></div></article><footer>f</footer>")
    # A block without a telling name that reads alike on all pages of a host goes; without an article the rest stays.
    site = [(i, "http://h.org/%d" % i, f"<body><div class='k'>always the same</div><div class='c'><p>text {i} of its own</p></div></body>") for i in range(12)]
    pages = spark.createDataFrame([(100, "http://x.org", page), (101, None, None), (102, "", ""), *site], "page_id long, url string, html string")
    out, name = html_text.extract(pages)
    got = {r["page_id"]: r[name] for r in out.collect()}
    assert got[100] == "A & B\none two\nthree" and got[101] == got[102] == "" and got[3] == "text 3 of its own" and len(got) == 15


def test_copies_of_a_page_change_no_text(spark):
    page = lambda i: f"<body><div class='k'>always the same</div><div class='post-body'><p>text {i} of its own</p></div></body>"
    rows = [(i, f"http://h.org/{i}", page(max(0, i - 290))) for i in range(320)]
    rows += [(1000 + i, f"http://few.org/{i}", page(i % 7)) for i in range(70)]  # seven different pages are too few to judge by
    out, name = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5))
    got = {r["page_id"]: r[name] for r in out.collect()}
    assert all(got[i] == f"text {max(0, i - 290)} of its own" for i in range(320))
    assert all(got[1000 + i] == f"always the same\ntext {i % 7} of its own" for i in range(70))


def test_language_model(docs, empty):
    out = lm.score_texts(docs).toPandas()
    rows = corpus()
    tokens = [(r[1] or "").encode().lower().split() + [b""] for r in rows]
    counts = collections.Counter(w for r, t in zip(rows, tokens, strict=True) if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 != 1 for w in t)
    total = sum(counts.values())
    base = [sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in t) for t in tokens]
    assert np.allclose(sorted(base), sorted(out.base_score)) and (out.train_tokens == total).all() and (out.score < 0).all()
    assert sorted(out.n_known) == sorted(sum(counts[w] > 0 for w in t) for t in tokens)
    assert lm.score_texts(empty).count() == 0


def test_words_beyond_the_commonest_have_contexts(spark):
    """Words at ranks above 32,768 are predicted by the words before them."""
    line = [f"w{i}" for i in range(40_000)]
    rows = [(i, " ".join(line)) for i in (1, 2, 3)] + [(4, " ".join(line[:35_000]))] * 2 + [(9, " ".join(line[39_000:]))]
    out = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), training=F.col("doc_id") < 9).where("doc_id = 9").first()
    assert out["score"] > 0.7 * out["base_score"]


def test_first_weights_come_from_texts_of_any_length(spark, monkeypatch):
    fitted = []
    fit = lm._fit
    monkeypatch.setattr(lm, "_fit", lambda mixer, both: (fit(mixer, both), fitted.append(mixer)))
    r = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in r.integers(0, 900, 6000))) for i in range(4)]
    out = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), training=F.lit(True)).toPandas()
    assert all(len(t) > 20_000 for _, t in rows) and len(out) == 4 and (out.score < 0).all()
    plain = lm.Mixer(fitted[0].code, fitted[0].zeros, fitted[0].ones)
    assert not np.allclose(fitted[0].weights, plain.weights, atol=1e-3)


def test_context_mixture_is_a_distribution():
    words = [(b"", 5), (b"a", 9), (b"b", 4), (b"c", 1)]
    code = lm.Code.build(words, 3, 22)
    r = np.random.default_rng(0)
    m = lm.Mixer(code, r.integers(0, 9, code.size()).astype(np.uint16), r.integers(0, 9, code.size()).astype(np.uint16))
    assert sum(10 ** m.score([np.array([s])])[0] for s in range(5)) == pytest.approx(1, abs=1e-5)


def test_context_counts_are_exact(spark):
    """Every context has counts of its own, however many there are."""
    r = np.random.default_rng(4)
    texts = [r.integers(1, 4000, 3000).astype(np.int64) for _ in range(4)]
    code = lm.Code.build([(b"%d" % i, 1 + 4000 // i) for i in range(1, 4000)], 1, 12000)
    rows = [(i // 2, zlib.compress(s.astype(np.int32).tobytes()), i != 3) for i, s in enumerate(texts)]
    coded = spark.createDataFrame(rows, "chunk long, symbols binary, train boolean").repartition("chunk").sortWithinPartitions("chunk")
    asks = coded.mapInArrow(lm._counted(0), lm.ASKS).repartition(3, "context").sortWithinPartitions("context", "chunk")
    told = asks.mapInArrow(lm._answered(code), "context long, chunk long, counts binary").collect()
    want = collections.defaultdict(collections.Counter)
    for s in texts[:3]:
        for c, x in zip(*lm.contexts([s], 0), strict=True):
            _, _, node, bit = code.paths(np.array([x]))
            want[c].update(zip(node.tolist(), bit.tolist(), strict=True))
    seen = 0
    for chunk in (0, 1):
        got = sorted((r["context"], bytes(r["counts"])) for r in told if r["chunk"] == chunk)
        both = texts[2 * chunk:2 * chunk + 2]
        m = lm.Mixer(code, *np.zeros((2, code.size()), np.uint16)).meet(np.array([c for c, _ in got]), np.frombuffer(b"".join(x for _, x in got), np.uint32), both)
        at = np.concatenate(m.places(both))
        for k, (c, x) in enumerate(zip(*lm.contexts(both, 0), strict=True)):
            _, _, node, _ = code.paths(np.array([x]))
            for j, n in enumerate(node.tolist()):
                assert (m.zeros[at[k] + j], m.ones[at[k] + j]) == (want[c][n, 0], want[c][n, 1])
                seen += 1
    assert seen > 100_000


def test_toxicity_reads_words_without_spaces_whole():
    plain = "一二三四五六七八九十" * 20
    r = np.random.default_rng(5)
    mixed = "".join(chr(0x4E00 + int(c)) for c in r.integers(0, 2000, 500))
    for text in (mixed, "under_scored_words_" * 30 + "vile", "a" * 161, "\ud800" * 90):
        pieces = toxicity.inputs_of(text)
        read = {p.decode("utf-8", "surrogatepass")[i:i + n] for p in pieces for n in range(3, 7) for i in range(len(p) - n + 1)}
        assert all(text[i:i + n] in read for n in range(3, 7) for i in range(len(text) - n + 1))
    assert toxicity.inputs_of("A b " + "c" * 160) == [b"a", b"b", b"c" * 160]
    net = toxicity.Network([toxicity.inputs_of(plain + "劣悪劣悪劣悪"), toxicity.inputs_of(plain)] * toxicity.SEEN)
    _, top, _ = toxicity.Scorer(net)([plain, plain + "劣悪劣悪劣悪", "y " + plain, "y " + plain + "劣悪劣悪劣悪"])
    assert top[0] != top[1] and top[2] != top[3]


def test_toxicity_learns_a_word(spark, empty):
    r = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(240):
        words = [f"w{x}" for x in r.integers(0, 40, 90)]
        if i % 4 == 0:
            words[10::20] = ["vile"] * len(words[10::20])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    out, name = toxicity.score(docs, toxicity.fit(docs, marks))
    got = out.toPandas().set_index("doc_id")[name]
    right = [(got[i] >= 0.3) == (i % 4 == 0) for i in range(240)]
    assert np.mean(right) > 0.95 and got.between(0, 1).all() and got[900] < 0.3
    plain, name = toxicity.score(empty, toxicity.fit(empty, marks))
    assert plain.count() == 0
