"""Small helpers the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lintel.session import ensure_checkpoint_dir

# A word is a run of anything but space and the control characters TAB..CR.
# ``bytes.split()`` cuts at exactly these six characters, as this expression does.
WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]+"

TOKENIZER = "word_bpe_49k.json"

_NAMES = itertools.count()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared ``spark.checkpoint.dir`` and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not use, in any letter case."""
    used = {c.lower() for c in df.columns}
    found = f"__{name}"
    while found.lower() in used:
        found = f"__{name}_{next(_NAMES)}"
    return found


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Give freed memory back to the machine: workers live on, idle or in other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc's; what Python and numpy freed stays with the worker otherwise
    if trim:
        trim(0)


def releasing(run: Batches) -> Batches:
    """``run`` for ``mapInArrow`` that gives a task's freed memory back at its end."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return task


HOT = 256               # keys that more than one in HOT rows have are sent to the rows: there are fewer than HOT of them


def attach_by_size(rows: DataFrame, side: DataFrame, key: str, of: str, size: str = "size") -> DataFrame:
    """``rows`` left-joined with a row of ``side`` (a written table) by ``key`` = ``of``; ``size`` says how many rows a key has.

    Keys of very many rows go by broadcast, so none fills a task; rows with a null key meet no join.
    """
    total = side.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    hot, cold = (side.where(c).drop(size) for c in (F.col(size) * HOT > total, F.col(size) * HOT <= total))
    told = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot), F.col(key) == F.col(of), "left")
    met = told.where(F.col(of).isNull()).select(*rows.columns).join(cold, F.col(key) == F.col(of), "left")
    return met.unionByName(told.where(F.col(of).isNotNull())).unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def word_list(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased, as UTF-8 bytes (Python side of ``words``)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key's decimal text, modulo ``modulus``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
