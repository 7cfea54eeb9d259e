"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every text gets base counts and a few rates.  For each rule (one rate) and
stratum, cutoffs from a fixed grid are tested from the most lenient down: on the
labelled good documents of the stratum, the exact binomial probability of seeing
so few rejections if the true false-rejection rate were the allowed one must stay
below the significance level.  Testing stops at the first failure (fixed-sequence
testing needs no correction along the grid), and the level is divided by the
number of rules times strata (Bonferroni).  The allowed rate of a stratum is
shared by its rules, so with probability 1 - ``level`` no stratum loses more than
``max_false_rejection`` of its good documents to the rules.  Among the certified
cutoffs the one that rejects most bad documents for the good ones it costs wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lintel.llm.common import checkpointed, fresh, words

SYMBOLS = r"[#*$%&|<>]"
GRAM = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

# Rules: rate name -> grid of cutoffs (a rate above its cutoff rejects).
RATES = ("symbol_rate", "dup_line_rate", "repeat_rate", "shout_rate", "word_length")
SHARE_GRID = [round(0.02 * i, 2) for i in range(1, 50)]
LENGTH_GRID = [float(i) for i in range(6, 41)]
GRIDS = {r: (LENGTH_GRID if r == "word_length" else SHARE_GRID) for r in RATES}

MAX_FALSE_REJECTION = 0.05
LEVEL = 0.05
GOOD_COST = 200  # a lost good document weighs as much as so many caught bad ones

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def add_features(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the base counts and rates; the dict maps their names to the columns used.

    Null text counts as empty: all counts and rates are 0.  Input columns keep
    their names; the added ones avoid clashes.
    """
    col = {n: fresh(n, docs) for n in ("words", "lines", "grams", "sorted", "spots", *BASE, *RATES, "base_failed")}
    c = lambda n: F.col(col[n])
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn(col["words"], words(F.col(text)))
    out = out.withColumns({
        col["n_words"]: F.size(c("words")).cast("long"),
        col["word_chars"]: F.length(F.array_join(c("words"), "")).cast("long"),
        col["n_symbols"]: F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        col["shout_rate"]: F.regexp_count(whole, F.lit("[!?]{2,}")).cast("double"),
        col["lines"]: F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        col["grams"]: F.when(F.size(c("words")) > GRAM, F.transform(
            F.sequence(F.lit(0), F.size(c("words")) - GRAM),
            lambda i: F.xxhash64(*[F.get(c("words"), i + k) for k in range(GRAM)]))),
    }).drop(col["words"])
    out = out.withColumns({
        col["n_dup_lines"]: (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        # Only a text with a repeated window is sorted; most texts have none.
        col["sorted"]: F.when(F.size(F.array_distinct(c("grams"))) < F.size(c("grams")), F.sort_array(
            F.transform(c("grams"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    })
    out = out.withColumn(col["spots"], F.sort_array(F.transform(
        F.filter(c("sorted"), lambda s, k: F.coalesce(F.get(c("sorted"), k + 1)["h"] == s["h"], F.lit(False))
                 | F.coalesce(F.get(c("sorted"), k - 1)["h"] == s["h"], F.lit(False))), lambda s: s["i"])))
    # A repeated window at i covers the words i..i+4; overlaps count once.
    covered = F.aggregate(F.transform(c("spots"), lambda i, k: F.least(F.lit(GRAM), F.coalesce(F.get(c("spots"), k + 1) - i, F.lit(GRAM)))),
                          F.lit(0), lambda s, x: s + x)
    out = out.withColumn(col["n_repeat_words"], F.coalesce(covered, F.lit(0)).cast("long"))
    per = lambda n, d: F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))
    out = out.withColumns({
        col["symbol_rate"]: per(c("n_symbols"), c("word_chars")),
        col["dup_line_rate"]: per(c("n_dup_lines"), F.size(c("lines"))),
        col["repeat_rate"]: per(c("n_repeat_words"), c("n_words")),
        col["shout_rate"]: per(c("shout_rate"), c("n_words")),
        col["word_length"]: per(c("word_chars"), c("n_words")),
        col["base_failed"]: (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > REPEAT_PERCENT * c("n_words")),
    })
    # The generator keeps later filters above it: pushed below, they would repeat the array work inside its own loops.
    names, row = [col[n] for n in (*BASE, *RATES, "base_failed")], fresh("row", out)
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(F.struct(*names))).alias(row))
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(row)[n].alias(n) for n in names])
    return out, {n: col[n] for n in (*BASE, *RATES, "base_failed")}


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exactly, as a column expression.

    Sums down from k by the ratio of neighbouring terms.  Above the mean the
    tail exceeds any level of interest; 1 is returned without summing.
    """
    import math
    odds = math.log(p) - math.log1p(-p)
    nd, none = n.cast("double"), F.array().cast("array<int>")
    top = F.aggregate(F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(none), nd * math.log1p(-p),
                      lambda s, i: s + F.log((nd - i + 1) / i) + F.lit(odds))
    # Terms below the k-th, relative to it: s = 1 + r_k (1 + r_{k-1} (1 + ...)).
    below = F.aggregate(F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(none), F.lit(1.0),
                        lambda s, i: 1.0 + s * i / (nd - i + 1) * math.exp(-odds))
    return F.when(k.cast("double") > nd * p, F.lit(1.0)).otherwise(F.exp(top) * below)


def _passed(rule: str, rate: str) -> Column:
    """How many cutoffs of the rule's grid a rate exceeds."""
    value = F.col(rate)
    return F.size(F.filter(F.array(*[F.lit(g) for g in GRIDS[rule]]), lambda g: g < value))


def certify(labelled: DataFrame, rates: dict[str, str], stratum: str, good: str,
            max_false_rejection: float = MAX_FALSE_REJECTION, level: float = LEVEL) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, lost_good, caught_bad, p_value)``, one row per certified rule and stratum.

    ``labelled`` has one row per labelled document: ``rates`` (name -> column),
    ``stratum`` (null is a stratum of its own) and the boolean ``good``; rows with
    a null label are ignored.  A stratum with too few good documents for the level
    gets no row, so nothing of it is rejected.
    """
    long = labelled.where(F.col(good).isNotNull()).select(
        F.col(stratum).alias("stratum"), F.col(good).alias("good"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _passed(r, v).alias("passed")) for r, v in rates.items()])).alias("x"))
    counts = checkpointed(long.groupBy("stratum", "x.rule", "x.passed").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    # A value above the j-th cutoff has passed more than j of them; one row per cutoff.
    every = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.collect_list(F.struct("passed", "good", "bad")).alias("hist"))
    grid = F.create_map(*[x for r in rates for x in (F.lit(r), F.array(*[F.lit(g) for g in GRIDS[r]]))])
    tested = every.select("stratum", "rule", "n_good", "hist", F.posexplode(grid[F.col("rule")]).alias("j", "cutoff")).select(
        "stratum", "rule", "n_good", "j", "cutoff",
        F.aggregate("hist", F.lit(0).cast("long"), lambda s, x: s + F.when(x["passed"] > F.col("j"), x["good"]).otherwise(0)).alias("lost_good"),
        F.aggregate("hist", F.lit(0).cast("long"), lambda s, x: s + F.when(x["passed"] > F.col("j"), x["bad"]).otherwise(0)).alias("caught_bad"))
    tested = tested.withColumn("p_value", binomial_tail(F.col("lost_good"), F.col("n_good"), max_false_rejection / len(rates)))
    strata = every.select(F.count_distinct(F.struct(F.coalesce(F.col("stratum").cast("string"), F.lit("")), F.col("stratum").isNull())).alias("n"))
    limit = F.lit(level) / (len(rates) * F.greatest(strata.scalar(), F.lit(1)))
    lenient_first = Window.partitionBy("stratum", "rule").orderBy(F.desc("cutoff"))
    certified = (tested.withColumn("failed", F.max((F.col("p_value") > limit).cast("int")).over(lenient_first)).where("failed = 0")
                 .withColumn("gain", F.col("caught_bad") - GOOD_COST * F.col("lost_good")).where("gain > 0"))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("cutoff"))
    return (certified.withColumn("place", F.row_number().over(best)).where("place = 1")
            .select("stratum", "rule", "cutoff", "n_good", "lost_good", "caught_bad", "p_value"))


def verdict(featured: DataFrame, col: dict[str, str], thresholds: DataFrame, stratum: str, kept: str) -> DataFrame:
    """``featured`` plus the boolean ``kept``: the base passed and no rate lies above its stratum's cutoff.

    The cutoffs (a handful of rules per stratum) are sent to the rows, so no text is
    shuffled or sorted by stratum: one row per stratum that has enough labelled good
    documents to certify a cutoff (over 450 each by default).
    """
    key, cuts = fresh("stratum", featured), fresh("cuts", featured)
    rows = thresholds.groupBy(F.col("stratum").alias(key)).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(cuts))
    out = featured.join(F.broadcast(rows), featured[stratum].eqNullSafe(F.col(key)), "left")
    above = F.lit(False)
    for r in RATES:
        above = above | F.coalesce(F.col(col[r]) > F.col(cuts)[r], F.lit(False))
    return out.withColumn(kept, ~F.col(col["base_failed"]) & ~above).drop(key, cuts)


def labelled_by(featured: DataFrame, labels: DataFrame, col: dict[str, str], stratum: str, key: str = "doc_id") -> DataFrame:
    """Rates, stratum and label of the rows that ``labels`` (doc_id, quality) covers; several labels of one document: the least."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg((F.min("quality") == 1).alias("__good"))
    return featured.select(F.col(key).alias("__key"), F.col(stratum).alias("__stratum"), *[col[r] for r in RATES]).join(
        marks, F.col("__key") == F.col("__id")).drop("__key", "__id")


def assess(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang",
           max_false_rejection: float = MAX_FALSE_REJECTION, level: float = LEVEL) -> tuple[DataFrame, dict[str, str], str]:
    """Every row of ``docs`` with its features and verdict: ``(frame, feature columns, kept column)``.

    Null or empty text fails the base.  Repeated rows are judged each on their own,
    equal rows alike.  Without labels nothing is certified and the base alone decides.
    """
    seen, col = add_features(docs, text)
    # Labels meet the few numbers of a document, not its text: the text is read once more rather than shuffled.
    cuts = certify(labelled_by(seen, labels, col, stratum), {r: col[r] for r in RATES}, "__stratum", "__good", max_false_rejection, level)
    kept = fresh("kept", seen)
    return verdict(seen, col, cuts, stratum, kept), col, kept
