"""The methods themselves: propagation, style trees, as-of answers and norms, each against a plain version or with the method switched off."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lintel.llm")

from lintel.llm import embeddings, html_text, minhash, mixing, sharding, url_lists  # noqa: E402


def test_quotas_keep_capacities_and_never_exceed_wishes():
    r = np.random.default_rng(3)
    for _ in range(50):
        n = int(r.integers(2, 17))
        load = r.integers(0, 1000, n).astype(float)
        wished = r.random((n, n)) * load[:, None] / n
        np.fill_diagonal(wished, 0)
        caps = load + r.integers(0, 50, n)
        got = sharding.quotas(load, wished, caps)
        assert (got >= 0).all() and (got <= wished + 1e-9).all()
        assert (load + got.sum(axis=0) - got.sum(axis=1) <= caps + 1).all()
    assert (sharding.quotas(np.array([5.0, 5.0]), np.array([[0, 3.0], [3.0, 0]]), np.array([5.0, 5.0])) == [[0, 3], [3, 0]]).all()


def test_propagation_joins_groups_round_by_round(spark):
    r = np.random.default_rng(4)
    rows = [(f"g{g}", int(s), int(s), int(r.integers(5, 60)), g, g % 3) for g in range(400) for s in sorted(set(r.integers(0, 8, 4)))]
    pieces = spark.createDataFrame(rows, "group_id string, origin int, shard int, bytes long, draw long, bucket int")
    load = np.bincount([x[1] for x in rows], [x[3] for x in rows], 8)
    caps = np.full(8, load.max() * 1.02)

    def apart(found):
        at = collections.defaultdict(set)
        for x in found:
            at[x["group_id"]].add(x["shard"])
        return sum(len(v) > 1 for v in at.values())

    cut = [apart(pieces.collect())]
    for rounds in (1, 8):
        found = sharding.propagate(pieces, caps.tolist(), rounds).collect()
        assert sorted((x["group_id"], x["origin"], x["bytes"]) for x in found) == sorted((x[0], x[1], x[3]) for x in rows)
        assert (np.bincount([x["shard"] for x in found], [x["bytes"] for x in found], 8) <= caps + 1).all()
        cut.append(apart(found))
    assert cut[0] > 350 and cut[1] < 0.35 * cut[0] and cut[2] <= cut[1]


def test_switching_propagation_off_changes_shards(spark):
    docs = spark.createDataFrame([(i, f"copy {i // 4}" if i < 2000 else f"lone {i}") for i in range(4000)], "doc_id long, text string")
    on, off = ({r["doc_id"]: r["shard"] for r in sharding.shard(docs, shards=4, rounds=n).collect()} for n in (8, 0))
    assert on != off and len(on) == len(off) == 4000


def test_norms_of_very_large_and_very_small_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [2e200, 2.1e200]), (2, [1e-200, 1e-200]), (3, [-1e300, 1e300])]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id").collect()
    assert [(r["n_links"], r["component_id"]) for r in got] == [(2, 0), (2, 0), (2, 0), (0, 3)]


def decide(url, at, entries):
    """The most specific entry in force, by scanning all entries."""
    host = url.split("://")[1].split("/")[0]
    labels = host.split(".")
    asked = [("url", url.split("://")[1]), ("host", host), ("domain", host)]
    if not host.replace(".", "").isdigit():
        asked += [("domain", ".".join(labels[i:])) for i in range(1, len(labels) - 1)]
    for kind, pattern in asked:
        held = [(e[3], e[2]) for e in entries if e[0] == kind and e[1] == pattern and e[3] <= at]
        if held:
            return max(held)[1], kind, pattern
    return "none", None, None


def test_url_lists_like_a_scan_of_all_entries(spark):
    r = np.random.default_rng(5)
    hosts = ["a.example.org", "b.example.org", "x.y.example.com", "10.0.0.1", "other.net"]
    patterns = [("host", h) for h in hosts[:3]] + [("domain", d) for d in ("example.org", "example.com", "y.example.com", "0.1", "other.net")] + [("url", "other.net/p1"), ("url", "10.0.0.1/p2")]
    entries = sorted({(*patterns[i], str(a), int(d)) for i, a, d in zip(r.integers(0, len(patterns), 80), r.choice(["allow", "block"], 80), r.integers(0, 100, 80), strict=True)})
    captures = [(i, f"http://{hosts[h]}/p{p}", int(t), "text", 1.0) for i, (h, p, t) in enumerate(zip(r.integers(0, 5, 300), r.integers(0, 4, 300), r.integers(0, 100, 300), strict=True))]
    frame = spark.createDataFrame(captures, "t int, url string, fetched_at int, u string, best double")  # names the join uses itself
    got = url_lists.filter_urls(frame, spark.createDataFrame(entries, "kind string, pattern string, action string, effective_at int"))
    assert got.columns[:5] == ["t", "url", "fetched_at", "u", "best"] and got.where("u <> 'text'").count() == 0
    found = {x["t"]: (x["decision"], x["matched_kind"], x["matched_pattern"]) for x in got.collect()}
    assert found == {c[0]: decide(c[1], c[2], entries) for c in captures}
    assert {"none", "allow", "block"} == {v[0] for v in found.values()} and {None, "url", "host", "domain"} == {v[1] for v in found.values()}
    assert url_lists.filter_urls(frame.limit(0), spark.createDataFrame(entries, "kind string, pattern string, action string, effective_at int")).where(F.lit(True)).count() == 0


def test_inline_noise_and_hinting_names():
    page = "<nav><p>Menu</p></nav><article><h1>T</h1><p>One.</p>{}<p>Two.</p></article>"
    kept = {
        '<p>in <span class="ad">Buy</span> x <a class="share">S</a><button>B</button><label>L</label> y</p>': "in x y",
        '<div class="search-tips">Tips</div>': "Tips", '<p class="note legal">Note</p>': "Note", '<div class="ad-slot wide">A</div>': None,
        '<section class="comments"><p>c</p></section>': None, '<p class="promo">P</p>': None, "": None,
    }
    for part, text in kept.items():
        assert html_text.main_text(page.format(part), set()) == "\n".join(x for x in ("T", "One.", text, "Two.") if x)
    teaser = "<article><p>teaser</p></article><div><p>" + "story " * 100 + "</p><p>end</p></div>"
    assert html_text.main_text(teaser, set()).startswith("teaser\nstory")
    assert html_text.main_text("<article><p>whole</p></article><div>beside</div>", set()) == "whole"


def test_style_trees_decide_inside_and_outside_articles(spark, monkeypatch):
    """Entropy removes what repeats and keeps what varies, by the same rule at every number of pages; brute force of one node's entropy."""
    r = np.random.default_rng(6)
    prose = lambda: " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps"], 12))
    rows = [(i, f"http://h.example/{i}", f"<article><h1>t{i}</h1><p>{prose()}</p><div class='search-tips'>the same tips</div><p class='note legal'>{prose()}</p>"
             f"<div class='strip'>follow us</div></article>") for i in range(30)]
    rows += [(100 + i, f"http://plain.example/{i}", f"<body><div class='a'>site line</div><div class='b'><p>{prose()} {i}</p></div></body>") for i in range(30)]
    rows += [(200, "http://one.example/", "<div class='a'>site line</div><div class='b'>own text</div>"), (201, None, None), (202, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    tree = html_text.style_tree(pages.select(url_lists.host_of(F.col("url")).alias("host"), "html")).where("host = 'h.example'").collect()
    assert sorted(round(x["importance"], 6) for x in tree)[:2] == [round(4 / 34, 6)] * 2 and len(tree) == 3

    def texts(**options):
        found, name = html_text.extract(pages, **options)
        return {x["page_id"]: x[name] for x in found.collect()}

    on, off = texts(), texts(low=0.0)
    assert all("same tips" not in on[i] and "follow us" not in on[i] and on[i].count("\n") == 2 for i in range(30))
    assert all("same tips" in off[i] and "follow us" in off[i] for i in range(30))
    assert all("site line" not in on[100 + i] and "\n" not in on[100 + i] for i in range(30))
    assert (on[200], on[201], on[202]) == ("site line\nown text", "", "")
    monkeypatch.setattr(html_text, "BROADCAST", 0)
    assert texts() == on


def test_budgets_of_few_long_documents_near_the_best_subset():
    r = np.random.default_rng(7)
    for _ in range(40):
        lengths = np.unique(r.integers(40_000, 2_000_000, 5))
        counts = r.integers(1, 4, len(lengths))
        budget = int(r.uniform(0.05, 0.95) * (lengths * counts).sum())
        sums = np.array([np.dot(lengths, x) for x in itertools.product(*[range(c + 1) for c in counts])])
        best = int(sums[sums <= budget].max())
        take = mixing.fit(lengths, counts, budget)
        got = int((take * lengths).sum())
        assert (take >= 0).all() and (take <= counts).all() and best - 0.001 * budget <= got <= best


def test_targets_by_filling_to_a_level(spark):
    """Targets again by bisection of the level, for many random sources with a null one."""
    r = np.random.default_rng(8)
    for n in (1, 2, 9):
        sizes = {(None if i == n - 1 else f"s{i}"): int(r.integers(0, 1000)) for i in range(n)}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {x["source"]: x["target"] for x in mixing.targets(rows).collect()}
        order = sorted(sizes, key=lambda x: (x is None, x or ""))
        weight = {x: (3.0, 1.0, 2.0)[i % 3] for i, x in enumerate(order)}
        lo, hi, budget = 0.0, 1e9, 1.5 * sum(sizes.values())
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(2 * sizes[x], mid * weight[x]) for x in sizes) < budget else (lo, mid)
        assert got == pytest.approx({x: min(2 * sizes[x], hi * weight[x]) for x in sizes}, abs=1e-3)


def near_copies(bases=3, copies=650, words=60, seed=9):
    """Crowds of near copies: texts of a base with up to a sixth of the words replaced by new ones, and texts of their own."""
    r = np.random.default_rng(seed)
    texts = []
    for b in range(bases):
        base = [f"b{b}w{i}" for i in range(words)]
        for c in range(copies):
            t = list(base)
            start = int(r.integers(0, words))
            for k in range(int(r.integers(0, words // 6))):
                t[(start + k) % words] = f"n{b}-{c}-{k}"
            texts.append(" ".join(t))
    return texts + [" ".join(f"own{i}-{k}" for k in range(30)) for i in range(200)]


def exact_links(texts, width=5, percent=80):
    """Links of all pairs, through a matrix of shingles."""
    seen, rows = {}, []
    for t in texts:
        w = t.split()
        rows.append(np.array(sorted({seen.setdefault(tuple(w[i:i + width]), len(seen)) for i in range(len(w) - width + 1)})))
    has = np.zeros((len(rows), len(seen)), np.float32)
    for i, x in enumerate(rows):
        has[i, x] = 1
    both = has @ has.T
    size = has.sum(axis=1)
    link = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(link, False)
    return link


def classes_of(link):
    label = np.arange(len(link))
    while True:
        least = np.where(link, label[None, :], len(link)).min(axis=1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def test_links_in_crowds_of_near_copies(spark):
    """With the production parameters, crowds above SMALL are found whole; the share of exact links that lie in one component is the recall."""
    texts = near_copies()
    link = exact_links(texts)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().sort_values("doc_id").component_id.to_numpy()
    a, b = np.nonzero(link)
    recall = (got[a] == got[b]).mean()
    print("link recall", recall)
    assert link.sum() > 50_000 and recall >= 0.99, recall
    assert (classes_of(link)[got] == classes_of(link)).all()          # none joined without links


@pytest.mark.parametrize("limit", [20_000])
def test_great_groups_in_parts_of_bounded_size(spark, monkeypatch, limit):
    texts = near_copies(2, 150)
    monkeypatch.setattr(minhash, "GROUP_BYTES", limit)
    monkeypatch.setattr(minhash, "SMALL", 16)
    monkeypatch.setattr(minhash, "LARGE", 32)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().sort_values("doc_id").component_id
    assert got.tolist() == classes_of(exact_links(texts)).tolist()


def test_links_between_parts_are_whole(spark):
    """Chains, a main component with others beside it, and groups without any link: the forest connects what brute force connects."""
    r = np.random.default_rng(1)
    sets = [np.arange(i * 2, i * 2 + 40) for i in range(60)] + [np.r_[5000:5040, 6000 + i] for i in range(60)] + [np.arange(9000 + 50 * i, 9040 + 50 * i) for i in range(30)]
    order = r.permutation(len(sets))
    items = spark.createDataFrame([(int(i), sets[i].astype(np.uint64).tobytes()) for i in order], "cls long, items binary")
    members = items.select(F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("grp"), "cls", F.length("items").alias("bytes"))
    share = np.array([[len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for y in sets] for x in sets]) >= 0.8
    np.fill_diagonal(share, False)
    want = classes_of(share)
    for limit in (700, 5_000):
        edges = [(r["a"], r["b"]) for r in minhash.linked(members, items, minhash._verify(80), limit).collect()]
        assert all(share[a, b] for a, b in edges)
        made = np.zeros_like(share)
        for a, b in edges:
            made[a, b] = made[b, a] = True
        assert (classes_of(made) == want).all()


def test_link_recall_of_vectors_in_crowds_over_shards(spark):
    """Links counted over several shards against brute force, crowds of near copies at the threshold included."""
    r = np.random.default_rng(3)
    d = 24
    base = r.standard_normal((6, d))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    crowd = np.concatenate([b + r.uniform(0.02, 0.08) * r.standard_normal((400, d)) for b in base])
    x = np.concatenate([crowd, r.standard_normal((600, d))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    got = embeddings.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), shards=4, shard_rows=750)
    got = got.toPandas().sort_values("vec_id")
    recall = got.n_links.sum() / link.sum()
    assert link.sum() > 50_000 and (got.n_links.to_numpy() <= link.sum(axis=1)).all() and recall >= 0.95, recall
    exact, found = classes_of(link), got.component_id.to_numpy()
    a, b = np.nonzero(link)
    assert (exact[found] == exact).all() and (found[a] == found[b]).mean() >= 0.95
    print("link recall", recall)
