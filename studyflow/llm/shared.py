"""Helpers shared by the operators: documents, word hashes, per-worker objects and connected components."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.session import discard, settings, work_path  # noqa: F401 (settings: for the operators)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_in_worker(key: str, make):
    """An object made once for each Python worker and kept for its later tasks (a tokenizer, a cache of bounded size)."""
    held = sys.modules.setdefault("_held_in_worker", types.ModuleType("_held_in_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


# A key with more rows than this, and than a thousandth of all rows, is dealt over several tasks.
EVEN_SHARE = 256


def joined_evenly(rows: DataFrame, counted: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``counted``, which has one row a key and the number ``n`` of its rows, of ``total`` in all.

    The rows of a heavy key are dealt over salted copies of its counted row. At most a thousand keys are heavy, so their list is broadcast.
    """
    share = max(EVEN_SHARE, total // 1000)
    pieces = F.ceil(F.col("n") / share).cast("int")
    heavy = F.broadcast(counted.where(F.col("n") > share).select(key, pieces.alias("__pieces")))
    dealt = rows.join(heavy, key, "left").withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.coalesce("__pieces", F.lit(1))).cast("int"))
    copies = counted.withColumn("__salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return dealt.join(copies, [key, "__salt"]).drop("__salt", "__pieces")


def star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """One step over at most ``total`` edges (a, b): the neighbours of a node are tied to the least of them.

    The large step moves the greater neighbours, the small step the lesser ones and the node itself.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    tied = joined_evenly(both, least, "a", total)
    if large:
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node in ``edges`` (a, b): the least id that it reaches.

    Steps of large and small stars until nothing changes; each round is written to the shared folder, where it replaces the one before, and only
    a count and a checksum reach the driver.
    """
    spark, old = edges.sparkSession, None

    def written(rows: DataFrame) -> tuple[DataFrame, str]:
        path = work_path(spark, "stars")
        rows.write.parquet(path)
        return spark.read.parquet(path), path

    now, path = written(edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct())
    before, total = None, now.count()
    while True:
        old, (now, path) = path, written(star(star(now, True, 2 * total), False, total))
        discard(spark, old)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        before, total = state, state[0]


# A-Z become a-z; digits, a-z and all bytes of letters beyond ASCII stay; every other byte parts words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """The lower-cased (A-Z only) words of a whole text: runs of ASCII letters and digits and of characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def text_slices(texts: list[str | None], chars: int) -> Iterator[tuple[int, list[str | None]]]:
    """(place of the first, texts) of runs of whole texts that end with the one that reaches ``chars`` characters."""
    first, held = 0, 0
    for n, text in enumerate(texts):
        held += len(text or "")
        if held >= chars or n == len(texts) - 1:
            yield first, texts[first : n + 1]
            first, held = n + 1, 0
