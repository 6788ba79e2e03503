"""Helpers shared by the operators: tables, work folders and vectorised word hashing."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.session import work_dir

# A word is a run of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

SMALL_ROWS = 1_000_000  # rows of ids and labels that may be broadcast

BATCH_BYTES = 8 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    Needed where the driver found it by its own search path only; on a cluster the
    package is installed on the executors and the folder is searched in vain.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand rows to Python in batches of at most ``BATCH_BYTES``, unless the session says otherwise.

    A batch is held as Arrow, as Python objects and as what is made of them at once, in each
    worker of an executor.
    """
    if spark.sparkContext.getConf().get(_ARROW_BYTES) is None:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def as_table(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` below the cluster's shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and pins values such
    as row numbers that would otherwise be computed again.
    """
    spark = frame.sparkSession
    path = work_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def words_of(text: Column) -> Column:
    """The words of a text, native; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def text_keys() -> list[Column]:
    """Two independent 64-bit hashes of ``text``; together they name a distinct text."""
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]


def packed(text: Column, form=lambda t: t) -> Column:
    """A text, in the ``form`` in which it is read, as compressed bytes.

    They are a third less than what Spark's own compression leaves of a text in a shuffle.
    """

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else packed_bytes(form(t)) for t in texts], dtype=object)

    return pack(text)


def packed_bytes(text: str) -> bytes:
    """A text as compressed bytes, after its size."""
    whole = text.encode("utf-8", "surrogatepass")
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(whole, asbytes=True)


def unpacked_text(data: Column) -> Column:
    """The text of a column of :func:`packed` bytes; null stays null.

    A batch of bytes is handed back in batches of about ``BATCH_BYTES`` of text, however well texts were compressed.
    """

    @F.pandas_udf("string")
    def unpack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            held, size = [], 0
            for packs in batch:
                held.append(None if packs is None else unpacked(packs))
                size += len(held[-1] or "")
                if size > BATCH_BYTES:
                    yield pd.Series(held, dtype=object)
                    held, size = [], 0
            if held:
                yield pd.Series(held, dtype=object)

    return unpack(data)


def unpacked(data: bytes) -> str:
    """The text of :func:`packed` bytes."""
    size = int.from_bytes(data[:8], "little")
    return pa.Codec("zstd").decompress(data[8:], size, asbytes=True).decode("utf-8", "surrogatepass") if size else ""


@lru_cache(maxsize=64)
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to 2**bits - 1 of the hash base and of its inverse."""

    def series(base: int) -> np.ndarray:
        steps = np.full(1 << bits, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return series(_BASE), series(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``values[s:e]`` for each pair, from one running sum."""
    up, down = powers(max(14, len(values).bit_length()))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def lower_ascii(points: np.ndarray) -> np.ndarray:
    return np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    inside = (points != 32) & ((points - np.uint32(9)) > 4)
    edge = np.flatnonzero(np.concatenate(([False], inside)) != np.concatenate((inside, [False])))
    return edge[::2], edge[1::2]


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of code points."""
    return mix(_ranges(points.astype(np.uint64) + np.uint64(1), starts, ends) + (ends - starts).astype(np.uint64))


def word_hashes(points: np.ndarray) -> np.ndarray:
    return span_hashes(points, *word_spans(points))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive hashes; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    starts = np.arange(n)
    return mix(_ranges(hashes, starts, starts + size))


def sampled(key: Column, share: float) -> Column:
    """Whether a row belongs to a sample of about ``share``, decided by a hash of ``key``."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(min(1.0, share) * (1 << 30)))


def labelled(docs: DataFrame, marks: DataFrame, column: str, use: Column) -> DataFrame:
    """``text, label`` of the rows of ``docs`` that ``use`` allows and that have a label."""
    known = marks.select(F.col("doc_id").alias("marked"), F.col(column).cast("int").alias("label")).where("label in (0, 1)")
    # Ids and labels are 12 bytes a row: counted, so that only a small table is sent to all
    # tasks and the texts stay where they are; a larger one is joined by a shuffle.
    if known.count() <= SMALL_ROWS:
        known = F.broadcast(known)
    rows = docs.where(use).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(known, F.col("doc_id") == F.col("marked")).select("text", "label")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression, by Newton's method."""
    scale = x.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + ridge * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return np.concatenate([w[:1], w[1:] / scale])
