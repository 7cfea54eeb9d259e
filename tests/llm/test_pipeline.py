"""The corpus pipeline and its stages on small tables: nulls, repeats, clashing names, long and empty texts."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lintel.llm")

import corpus_pipeline  # noqa: E402
from lintel.llm import minhash, mixing, packing  # noqa: E402
from lintel.llm.common import tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, of long, sum long, ids int, grp string"


def table(spark, n=260):
    r = np.random.default_rng(1)
    vocabulary = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(r.choice(vocabulary, int(r.integers(15, 60)))), "en", f"s{i % 3}") for i in range(n)]
    rows += [(n + i, rows[i][1], "de", None) for i in range(20)]                         # copies
    rows += [(None, "no id " + rows[0][1], "en", "s0"), (5, rows[5][1], "en", "s2"), (900, None, None, None), (901, "", "en", "s0"), (902, rows[9][1] * 200, "fr", "s1")]
    return spark.createDataFrame([(*x, 7, 1, 2, 3, "g") for x in rows], SCHEMA)


def test_rows_of_one_id_with_different_texts_stay(spark):
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    rows = [(1, words[0]), (1, words[1]), (2, words[1]), (0, words[2]), (1, words[2]), (3, words[2]), (3, words[2]), (None, words[0]), (None, "alone " + words[2][:9]), (-4, None), (-4, "")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # Id 1 leads two groups and follows in a third; texts without words link with nothing.
    assert collections.Counter(tuple(r) for r in kept) == collections.Counter([(1, words[0]), (1, words[1]), (0, words[2]), (None, "alone " + words[2][:9]), (-4, kept[[r[0] for r in kept].index(-4)][1])])


def test_mixing_whole_rows_with_clashing_names(spark):
    docs = table(spark)
    taken = {r["doc_id"]: r for r in mixing.mix(docs.where("doc_id >= 0").dropDuplicates(["doc_id"])).collect()}
    rows = mixing.mix(docs.where("doc_id >= 0").dropDuplicates(["doc_id"]), whole_rows=True)
    assert rows.columns == docs.columns
    times = collections.Counter(r["doc_id"] for r in rows.collect())
    assert all(times[i] * r["size"] == r["taken"] for i, r in taken.items()) and max(times.values()) <= 2


def test_packed_ids_are_the_tokenizers(spark, monkeypatch):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(tokenizer_path())
    docs = table(spark)
    for bulk in (packing.CHUNK_BYTES, 4096):
        pack = packing._pack(256, ["id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"])
        monkeypatch.setattr(packing, "CHUNK_BYTES", bulk)
        pieces = [b for b in packing._pieces(tokenizer_path(), 256, True)(iter(docs.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("grp"), "text").toArrow().to_batches()))]
        out = [r for b in pack(iter(pieces)) for r in b.to_pylist()]
        found = collections.defaultdict(list)
        for r in sorted(out, key=lambda r: r["start"]):
            found[r["id"], r["doc_tokens"]].append(r["ids"])
        for row in docs.where("doc_id between 6 and 900").collect():
            ids = [*model.encode(row["text"] or "", add_special_tokens=False).ids, 1]
            assert [x for part in found[row["doc_id"], len(ids)] for x in part] == ids
        used = collections.Counter()
        for r in out:
            used[r["sequence_id"]] += r["length"]
        assert max(used.values()) <= 256


def test_pipeline_runs_over_odd_tables(spark, tmp_path):
    docs = table(spark)
    labels = [(i, int(i % 9 > 0), int(i % 5 == 0)) for i in range(260)]
    for name, rows in (("full", docs), ("empty", docs.limit(0))):
        base = tmp_path / name
        rows.write.parquet(str(base / "documents.parquet"))
        spark.createDataFrame(labels if name == "full" else [], "doc_id long, quality int, toxic int").write.parquet(str(base / "labels.parquet"))
        now = spark.read.parquet(str(base / "documents.parquet"))
        columns = now.columns
        for step, (stage, run) in enumerate(corpus_pipeline.STAGES):
            out = run(spark, now, str(base))
            if step < 4:
                assert out.columns == columns, stage
                out.write.parquet(str(base / stage))
                now = spark.read.parquet(str(base / stage))
            else:
                pieces = out.collect()
        if name == "empty":
            assert pieces == []
        else:
            want = collections.Counter(r["doc_id"] for r in now.collect())
            got = collections.Counter(r["doc_id"] for r in pieces if r["start"] == 0)
            assert got == want and len(want) > 50
            assert sum(len(r["ids"]) for r in pieces) == sum(r["length"] for r in pieces)
