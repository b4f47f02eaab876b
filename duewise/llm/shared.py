"""Small helpers that several training-data operators use."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
PIECE = 1 << 18  # bytes of one text that are looked at together


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> None:
    """Let a local master's Python workers find this package; a cluster gets it by --py-files.

    Batches of texts are kept to a few MB where the session has Spark's default of 64, so that a
    worker's memory does not follow the length of its texts.
    """
    if spark.conf.get(BATCH_BYTES, "1").rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH_BYTES, str(4 << 20))
    if spark.sparkContext.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def let_go() -> None:
    """Hand freed memory back to the system at a task's end: workers live on and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every system's library has it
        pass


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string")) % 4


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    """Rows without an id belong to no fold, so nothing is learned from them."""
    return F.coalesce(fold(doc_id) != 2, F.lit(False))


SIEVE_BITS = 24


def sifted(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` less most of those whose ``key`` is not among the keys of ``wanted`` (its only column).

    A table of 2 ** SIEVE_BITS bits, kept as at most 2 ** (SIEVE_BITS - 6) numbers whatever ``wanted``
    holds, is broadcast, so that wide rows which find no partner are not shuffled. What passes still
    has to be joined. Null keys pass.
    """
    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(1 << SIEVE_BITS))

    [name] = wanted.columns
    bits = wanted.where(F.col(name).isNotNull()).select(slot(name).alias("s")).groupBy(F.shiftright("s", 6).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("s") % 64).cast("int"))).alias("_bits")
    )
    marked = rows.withColumn("_slot", slot(key)).join(F.broadcast(bits), F.shiftright("_slot", 6) == F.col("_word"), "left")
    passes = F.col(key).isNull() | (F.call_function("getbit", F.col("_bits"), (F.col("_slot") % 64).cast("int")) == 1)
    return marked.where(passes).select(*rows.columns)


def sieve_flag(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``key`` is surely not among the keys of ``wanted`` (its only column).

    The same table of bits as in ``sifted``, for callers that also need the rows which it parts off.
    """
    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(1 << SIEVE_BITS))

    [name] = wanted.columns
    bits = wanted.select(slot(name).alias("s")).groupBy(F.shiftright("s", 6).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("s") % 64).cast("int"))).alias("_bits")
    )
    marked = rows.withColumn("_slot", slot(key)).join(F.broadcast(bits), F.shiftright("_slot", 6) == F.col("_word"), "left")
    maybe = F.coalesce(F.call_function("getbit", F.col("_bits"), (F.col("_slot") % 64).cast("int")) == 1, F.lit(False))
    return marked.select(*rows.columns, maybe.alias("_maybe"))


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts behind one another, and where each starts; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, starts, data = texts.buffers()
    starts = np.frombuffer(starts, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def padded_pieces(
    data: np.ndarray, starts: np.ndarray, before: int, most: int = 4 * PIECE
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts cut into pieces that carry ``before`` bytes of what precedes them, some MB at a time.

    Yields (bytes, row of each piece, where each piece's own bytes begin, and end). Spaces stand
    before a text's first byte. However long a text is, no array grows beyond about ``most``.
    """
    cuts = []
    size = 0

    def packed():
        out = np.full(size, 32, np.uint8)
        begins, ends, at = np.empty(len(cuts), np.int64), np.empty(len(cuts), np.int64), 0
        for k, (row, a, b) in enumerate(cuts):
            had = min(before, a - starts[row])
            out[at + before - had : at + before + b - a] = data[a - had : b]
            begins[k], ends[k] = at + before, at + before + b - a
            at = ends[k]
        return out, np.array([c[0] for c in cuts], np.int64), begins, ends

    for row in range(len(starts) - 1):
        for a in range(starts[row], starts[row + 1], PIECE):
            b = min(a + PIECE, starts[row + 1])
            cuts.append((row, a, b))
            size += before + b - a
            if size >= most:
                yield packed()
                cuts, size = [], 0
    if cuts:
        yield packed()
