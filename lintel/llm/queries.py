"""The registered queries of the training-data operators: thin views of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from lintel.llm import bpe, embeddings, html_text, lm, merkle, minhash, mixing, packing, periodic, quality, sharding, toxicity, url_lists
from lintel.llm.common import read, remainder, tokenizer_path, words


def op1_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures: the fetch day follows from the page id."""
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int")).alias("fetched_at"))


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated list entries that the captures themselves give rise to.

    Six hosts of sixteen (by a hash) are listed, renewed with their first capture of
    every month; eleven domains of sixteen, renewed on the forty-first day of every
    quarter in which they are seen; a URL with a tracking parameter from its first
    capture on.  The action follows from a hash of what is listed and when.
    """
    seen = captures(spark, sf_dir).where("url is not null").withColumn("host", url_lists.host_of(F.col("url"))).where("host <> ''")
    digit = lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    hosts = seen.where(digit(F.col("host")) < "6").groupBy(F.lit("host").alias("kind"), F.col("host").alias("pattern"), F.trunc("fetched_at", "month").alias("m")).agg(
        F.min("fetched_at").alias("effective_at")).drop("m")
    domains = seen.select(F.lit("domain").alias("kind"), domain.alias("pattern"), F.date_add(F.trunc("fetched_at", "quarter"), 40).alias("effective_at")).distinct()
    domains = domains.where((F.col("pattern") != "") & (digit(F.col("pattern")) < "b"))
    urls = seen.where(F.col("url").contains("utm_")).groupBy(F.lit("url").alias("kind"), url_lists.plain_url(F.col("url")).alias("pattern")).agg(F.min("fetched_at").alias("effective_at"))
    every = hosts.unionByName(domains).unionByName(urls)
    action = F.when(digit(F.concat_ws("|", "pattern", F.col("effective_at").cast("string"))) < "5", "block").otherwise("allow")
    return every.select("kind", "pattern", action.alias("action"), "effective_at")


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.filter_urls(captures(spark, sf_dir), list_entries(spark, sf_dir))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.score_texts(read(spark, sf_dir, "documents"))
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored, name = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), F.col(name).alias("score"),
                         (F.col(name) >= toxicity.CUTOFF).cast("int").alias("predicted"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    seen, col, kept = quality.assess(docs, read(spark, sf_dir, "labels"))
    return seen.select("doc_id", *[F.col(col[n]).alias(n) for n in (*quality.BASE, "base_failed")], F.col(kept).alias("kept"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def crc(key: Column) -> Column:
    """crc32 of a key's decimal text; null for a null key."""
    return F.crc32(key.cast("string").cast("binary"))


def op11_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, folded from the leaves of a copy in which every third document (by crc32 of its id) is lower-cased."""
    docs = read(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", UPPER, UPPER.lower())
    seen = F.when(crc(F.col("doc_id")) % 3 == 0, merkle.leaf(*[F.col(c) for c in fields[:-1]], lowered))
    proofs = merkle.build(docs, fields, carry={"seen": seen}).proofs()
    folded = proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
                           merkle.fold(F.coalesce("seen", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in one of ten documents all words from a place on repeat a period; both follow from the id (a null id's crc32 counts as 0)."""
    h = F.coalesce(crc(F.col("doc_id")), F.lit(0))
    g = F.floor(h / 10)
    w = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    a = F.col("g") % F.size("w")
    w = w.withColumn("a", F.when(F.size("w") > 0, a).cast("int"))
    w = w.withColumn("p", (1 + F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    planted = F.array_join(F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))), " ")
    return w.select("doc_id", F.when(F.col("p").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = periodic.periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    runs = F.col(name["runs"])
    best = periodic.strongest(runs)
    listed = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
                        F.sha2(name["collapsed"], 256).alias("collapsed_sha256"))


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), decoded=True)
    ids = F.col(name["ids"])
    return found.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2(name["decoded"], 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_embedding_groups, op2_url_lists, op3_pack_sequences, op4_main_text, op5_minhash_groups, op6_toxicity, op7_shards, op8_quality_rules,
             op9_context_mixing, op10_mix_sources, op11_merkle_proofs, op12_periodic_runs, op13_bpe_round_trip]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


# crc32 of a decimal text (at most 20 characters), bit by bit; h(x) stands for an input of a leaf.
_CRC = """(xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length({0}::varchar) + 1), lambda i: ascii(({0}::varchar)[i])::bigint)),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, b: xor(v >> 1, 3988292384 * (v & 1)))))::bigint)"""


def _leaf_sql(text: str) -> str:
    enter = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0}::varchar end"
    return "sha256(" + " || ".join(enter.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# The trees level by level: of the documents of each lang first, then of the subroots.  A path is kept as one list of left and right siblings per leaf.
MERKLE_SQL = f"""
with recursive
docs as (select row_number() over () as k, doc_id, lang, {_leaf_sql('text')} as leaf,
    case when {_CRC.format('doc_id')} % 3 = 0 then {_leaf_sql(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} end as seen from documents),
nodes as (
    select lang as grp, 0 as lvl, row_number() over (partition by lang order by doc_id nulls first, leaf, k) - 1 as pos, leaf as digest, count(*) over (partition by lang) as n from docs
    union all
    select grp, lvl + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), (max(n) + 7) // 8 from nodes where n > 1 group by grp, lvl, pos // 8),
subroots as (select grp, digest as subroot, row_number() over (order by grp nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1),
tops as (
    select 0 as lvl, pos, subroot as digest, n from subroots
    union all
    select lvl + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), (max(n) + 7) // 8 from tops where n > 1 group by lvl, pos // 8),
whole as (select digest as root from tops where n = 1),
runs as (select grp, lvl, pos // 8 as run, list(digest order by pos) as d from nodes where n > 1 group by all),
top_runs as (select lvl, pos // 8 as run, list(digest order by pos) as d from tops where n > 1 group by all),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf, k) - 1 as pos from docs),
steps as (
    select p.k, 0 as tree, r.lvl, (p.pos // pow(8, r.lvl)::bigint) % 8 as w, r.d from placed p
        join runs r on r.grp is not distinct from p.lang and r.run = p.pos // pow(8, r.lvl + 1)::bigint
    union all
    select p.k, 1, r.lvl, (s.pos // pow(8, r.lvl)::bigint) % 8, r.d from placed p join subroots s on s.grp is not distinct from p.lang
        join top_runs r on r.run = s.pos // pow(8, r.lvl + 1)::bigint),
paths as (select k, list({{'l': array_to_string(list_slice(d, 1, w), ''), 'r': array_to_string(list_slice(d, w + 2, 8), '')}} order by tree, lvl) as path from steps group by k),
folded as (select p.*, s.subroot, (select root from whole) as root, coalesce(h.path, []) as path from placed p join subroots s on s.grp is not distinct from p.lang left join paths h using (k))
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) as proof_sha256,
    list_reduce(list_prepend({{'l': coalesce(seen, leaf), 'r': ''}}, path), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l as folded_root,
    folded_root = root as verified
from folded"""


_HOST = r"regexp_replace(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)', 1), '^.*@|:[0-9]*$', '', 'g')), '\.$', '')"
_REST = r"regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\]*|#.*$', '', 'g')"

URL_SQL = f"""
with
seen as (select page_id, url, (date '2024-01-01' + (((page_id * 7919) % 365 + 365) % 365)::int)::date as fetched_at from pages),
cut as (select distinct url, fetched_at, {_HOST} as host, {_HOST} || case when {_REST} = '' then '/' else {_REST} end as plain from seen where url is not null),
listed as (
    select 'host' as kind, host as pattern, min(fetched_at) as effective_at from cut where host <> '' and md5(host)[1] < '6' group by host, date_trunc('month', fetched_at)
    union all
    select distinct 'domain', regexp_extract(host, '([^.]+\\.[^.]+)$', 1) as d, (date_trunc('quarter', fetched_at)::date + 40)::date from cut where host <> '' and d <> '' and md5(d)[1] < 'b'
    union all
    select 'url', plain, min(fetched_at) from cut where host <> '' and contains(url, 'utm_') group by plain),
daily as (select kind, pattern, effective_at, max(case when md5(concat_ws('|', pattern, effective_at::varchar))[1] < '5' then 'block' else 'allow' end) as action from listed group by all),
changes as (select *, lag(action) over (partition by kind, pattern order by effective_at) as b from daily),
valid as (select *, lead(effective_at) over (partition by kind, pattern order by effective_at) as until from changes where b is null or b <> action),
labelled as (select *, string_split(host, '.') as l from cut),
asked as (
    select url, fetched_at, 2 as rank, 0 as depth, 'url' as kind, plain as pattern from labelled
    union all select url, fetched_at, 1, 0, 'host', host from labelled
    union all select url, fetched_at, 0, len(l), 'domain', host from labelled
    union all select url, fetched_at, 0, len(l) - i, 'domain', array_to_string(list_slice(l, i, len(l)), '.')
        from (select *, unnest(range(2, len(l))) as i from labelled where not regexp_matches(host, '^[0-9.]+$|^\\['))),
best as (
    select a.url, a.fetched_at, a.kind, a.pattern, v.action, v.effective_at, row_number() over (partition by a.url, a.fetched_at order by a.rank desc, a.depth desc) as r
    from asked a join valid v on a.kind = v.kind and a.pattern = v.pattern and v.effective_at <= a.fetched_at and (v.until is null or a.fetched_at < v.until))
select s.page_id, s.url, s.fetched_at, coalesce(b.action, 'none') as decision, b.kind as matched_kind, b.pattern as matched_pattern, b.effective_at
from seen s left join best b on s.url = b.url and s.fetched_at = b.fetched_at and b.r = 1"""

# Links to components: what is reachable by links, from every node.
_REACHED = """reached as (select a as node, b as other from links union select r.node, l.b from reached r join links l on l.a = r.other)"""

MINHASH_SQL = fr"""
with recursive
texts as materialized (select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (select k, doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from texts),
parts as materialized (select k, len(s) as n, unnest(s) as x from sets),
links as materialized (select a.k as a, b.k as b from parts a join parts b on a.x = b.x and a.k <> b.k group by a.k, b.k, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
{_REACHED},
least as (select r.node, min(s.doc_id) as low from reached r join sets s on s.k = r.other group by r.node)
select s.doc_id, len(s.s)::bigint as n_shingles, case when l.low is null then s.doc_id when s.doc_id is null then l.low else least(s.doc_id, l.low) end as component_id,
    s.doc_id is not distinct from component_id as kept
from sets s left join least l on l.node = s.k"""

VECTOR_SQL = f"""
with recursive
vectors as materialized (select row_number() over () as k, vec_id, embedding::double[] as v from embeddings),
usable as materialized (select * from vectors where v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
links as materialized (select a.k as a, b.k as b from usable a join usable b on len(a.v) = len(b.v) and a.k <> b.k where list_cosine_similarity(a.v, b.v) >= 0.95),
{_REACHED},
least as (select r.node, min(s.vec_id) as low from reached r join vectors s on s.k = r.other group by r.node),
counts as (select a, count(*) as n from links group by a)
select x.vec_id, coalesce(c.n, 0)::bigint as n_links, case when l.low is null then x.vec_id else least(x.vec_id, l.low) end as component_id,
    x.vec_id is not distinct from component_id as kept
from vectors x left join least l on l.node = x.k left join counts c on c.a = x.k"""


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_groups": VECTOR_SQL, "op2_url_lists": URL_SQL, "op5_minhash_groups": MINHASH_SQL, "op11_merkle_proofs": MERKLE_SQL}
