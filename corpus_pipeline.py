"""A corpus pipeline in five stages, each one operator of ``lintel.llm`` over all that the stage before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lintel.llm import minhash, mixing, packing, quality, toxicity
from lintel.llm.common import read, tokenizer_path
from lintel.session import ensure_checkpoint_dir


def _own(frame: DataFrame, docs: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their stratum's certified cutoffs."""
    seen, _, kept = quality.assess(docs, read(spark, sf_dir, "labels"))
    return _own(seen.where(F.col(kept)), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity cutoff."""
    scored, name = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return _own(scored.where(F.col(name) < toxicity.CUTOFF), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0, 1 or 2 times)."""
    return mixing.mix(docs, whole_rows=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences, one row each, with their ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic),
    ("minhash_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Certified cutoffs, a trained network and seeded packing cannot be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus_pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
