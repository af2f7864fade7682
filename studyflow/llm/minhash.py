"""Near-duplicates by circulant MinHash.

Two permutations give every signature coordinate: the first lays the hashed shingles out on a circle of 2^32 places, the second is shifted by k
places for coordinate k. Bands of the signature propose groups; links are confirmed on the full shingle sets.

Documents with the same set become one representative first, so a group of copies costs one row. Sets that share a band are compared whole, in two
rounds, and only confirmed links tie documents:

1. Each set meets the least member of its band groups, the centre, and the others that chose it, in blocks of bounded size.
2. Of the band groups that still hold several components, the members outside the greatest component meet all others, block by block. Pairs that a
   confirmed path already ties need no comparison, so a large group of near-copies is compared once with its centre and not within itself. Groups
   with the same greatest component, which mostly hold the same sets, meet as one where that takes fewer rows.

A task returns only the edges of a spanning forest. The number of bands follows from the threshold: a pair at the threshold is missed with a chance
of 1e-8 at most, and a pair at 0.4 shares a band in 4 of 100 cases at 0.85 (7 at 0.8), one at 0.3 in 1 of 100 or fewer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studyflow.llm.shared import components, documents, joined_evenly, mix64, settings, window_hashes, word_hashes
from studyflow.session import staged

ROWS_PER_BAND = 8
MISS = 1e-8
# Sets of a candidate group that meet in one task; a larger group is compared in such blocks.
BLOCK = 256
# Coordinates of shingles that a signature works on at a time.
CELLS = 2**18
COLUMNS = 4096
# Texts of documents outside all clusters stay out of the shuffle: a Bloom filter of the members' ids goes to the scan.
FILTER_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}
# Bits of that filter for each member (Spark takes at most 2^26 in all; a fuller one only lets more texts through to the join).
FILTER_BITS = 16


def filter_conf(members: int) -> dict[str, str]:
    sized = {"expectedNumItems": min(max(members, 1), 2**22), "numBits": min(max(members, 64) * FILTER_BITS, 2**26)}
    return FILTER_CONF | {f"spark.sql.optimizer.runtime.bloomFilter.{k}": str(v) for k, v in sized.items()}


def bands_for(percent: int, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of a shorter text, the whole sequence is the only one."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(word_hashes(found), min(words, len(found))))


def permuted(x: np.ndarray) -> np.ndarray:
    """The second permutation, in place: a bijection of unsigned 32-bit numbers."""
    shifted = x >> np.uint32(16)
    x ^= shifted
    x *= np.uint32(0x7FEB352D)
    x ^= np.right_shift(x, np.uint32(15), out=shifted)
    x *= np.uint32(0x846CA68B)
    x ^= np.right_shift(x, np.uint32(16), out=shifted)
    return x


def signature(found: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates: the least of the second permutation, shifted by 0, 1, ... places, over the set's places on the circle."""
    places = (mix64(found) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(size, dtype=np.uint32)[None, :]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    step = max(1, CELLS // size)
    for at in range(0, len(places), step):
        np.minimum(least, permuted(places[at : at + step, None] + shifts).min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    table = coordinates.reshape(-1, rows).astype(np.uint64)
    keys = np.arange(1, len(table) + 1, dtype=np.uint64)
    for k in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, k])
    return keys.view(np.int64)


def signed(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, digest of the set and its band keys (no keys for an empty set)."""
    bands = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                keys.append(band_keys(signature(found, bands * ROWS_PER_BAND), ROWS_PER_BAND) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Square matrix: the sets i and j meet the threshold. Sizes of intersections are sums of products over blocks of shared shingles."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[code] > 1
    owner, code = owner[shared], code[shared]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((n, n), np.float64)
    if len(code):
        code = np.cumsum(np.concatenate(([0], (code[1:] != code[:-1]).astype(np.int64))))
        for low in range(0, int(code[-1]) + 1, COLUMNS):
            a, b = np.searchsorted(code, [low, low + COLUMNS])
            table = np.zeros((n, COLUMNS), np.float32)
            table[owner[a:b], code[a:b] - low] = 1
            common += table @ table.T
    both = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= percent * both


def forest(ids: np.ndarray, joined: np.ndarray) -> list[tuple[int, int]]:
    """(id, least id that it reaches) of the ids that reach a lesser one."""
    least = np.arange(len(ids))
    order = np.argsort(ids)
    ids, joined = ids[order], joined[np.ix_(order, order)]
    while True:
        now = np.where(joined, least[None, :], len(ids)).min(axis=1)
        now = np.minimum(now, least)
        now = now[now]
        if (now == least).all():
            return [(int(a), int(ids[b])) for a, b in zip(ids, least) if ids[b] != a]
        least = now


def links(texts: DataFrame, meetings: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed edges (a, b) as spanning forests: the sets of texts (id, text) that meet in a (cluster, low, high), where two different blocks
    are compared with each other only."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, own = pdf["id"].to_numpy(), pdf["own"].to_numpy()
        joined = linked([shingles(t, words) for t in pdf["text"]], percent)
        if pdf["low"].iat[0] != pdf["high"].iat[0]:
            joined &= own[:, None] != own[None, :]
        np.fill_diagonal(joined, False)
        return pd.DataFrame(forest(ids, joined), columns=["a", "b"], dtype="int64")

    # Both the filter and the join read them. Spark makes the filter only of a side that a comparison selects from; every block has a number from 0.
    meetings = staged(meetings, "meetings")
    with settings(texts.sparkSession, filter_conf(meetings.count())):
        found = texts.join(meetings.where("id is not null and own >= 0"), "id").groupBy("cluster", "low", "high").applyInPandas(compare, "a long, b long")
        return staged(found, "links")


def blocks(n: str) -> Column:
    return F.ceil(F.col(n) / BLOCK).cast("int")


def dealt(id_col: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(id_col), count).cast("int")


def with_centres(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First round over band groups (key, rep, centre): meetings of each set with its least centre, and the centres with their numbers of sets."""
    first = staged(groups.where("rep <> centre").groupBy("rep").agg(F.min("centre").alias("centre")), "first")
    sizes = staged(first.groupBy("centre").agg(F.count(F.lit(1)).alias("n")), "sizes")
    own = joined_evenly(first, sizes, "centre", first.count()).select(F.col("rep").alias("id"), F.col("centre").alias("cluster"), dealt("rep", blocks("n")).alias("own"))
    own = own.unionByName(sizes.select(F.col("centre").alias("id"), F.col("centre").alias("cluster"), F.explode(F.sequence(F.lit(0), blocks("n") - 1)).alias("own")))
    met = first.join(sizes.where(F.col("n") <= BLOCK).select("centre"), "centre").select("rep", F.col("centre").alias("met"))
    return own.withColumn("low", F.col("own")).withColumn("high", F.col("own")), met


def meeting_rows(n_rest: str, n_main: str) -> Column:
    """Rows of the meetings of n_rest sets with each other and with n_main more."""
    return F.col(n_rest) * (blocks(n_rest) + blocks(n_main)) + F.col(n_main) * blocks(n_rest)


def met_as_one(several: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each main component: main, its rows ``n`` in ``members``, and the level from which on its band groups meet as one cluster.

    The band groups of a large group of near-copies hold the same sets again and again. Taken together from the largest down (a level is a power
    of two of their size), each set is there once; the level is the one with the fewest rows in all meetings, and 64 if all stay apart.
    """
    apart = several.groupBy("main", "level").agg(F.sum(meeting_rows("n_rest", "n_main")).alias("rows"), F.sum("n").alias("n"))
    first = members.groupBy("main", "rep", "rest").agg(F.max("level").alias("level"))
    held = first.groupBy("main", "level").agg(F.count_if("rest").alias("all_rest"), F.count_if(~F.col("rest")).alias("all_main"))
    down = Window.partitionBy("main").orderBy(F.desc("level"))
    levels = apart.join(held, ["main", "level"], "left").fillna(0).select(
        "main", "level", "n", "rows", F.sum("all_rest").over(down).alias("all_rest"), F.sum("all_main").over(down).alias("all_main"), (F.sum("rows").over(Window.partitionBy("main")) - F.sum("rows").over(down)).alias("below")
    )
    best = F.min(F.struct((meeting_rows("all_rest", "all_main") + F.col("below")).alias("rows"), "level", "all_rest", "all_main"))
    found = levels.groupBy("main").agg(best.alias("best"), F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    return found.select("main", "n", F.when(F.col("best.rows") < F.col("rows"), F.col("best.level")).otherwise(64).alias("least"), "best.all_rest", "best.all_main")


def between_components(groups: DataFrame, met: DataFrame, tied: DataFrame) -> DataFrame:
    """Second round: meetings of the sets of band groups that hold several components (id, component) of ``tied`` after the first.

    Groups whose sets all met in the first round are done; groups of the same sets are compared once, and groups with the same greatest component
    meet as one cluster where that takes fewer rows. Two clusters with the same number would only compare more.
    """
    now = groups.join(met, "rep", "left").join(tied.withColumnRenamed("id", "rep"), "rep", "left")
    now = now.select("key", "rep", F.coalesce("component", "rep").alias("component"), ((F.col("rep") == F.col("centre")) | F.coalesce(F.col("met") == F.col("centre"), F.lit(False))).alias("done"))
    now = staged(now, "open")
    parts = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("part"), F.bool_and("done").alias("done"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
    several = parts.groupBy("key").agg(F.max(F.struct("part", "component")).alias("top"), F.sum("part").alias("n"), F.count(F.lit(1)).alias("parts"), F.bool_and("done").alias("done"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    several = several.where("parts > 1 and not done").groupBy("x", "y", "n").agg(F.min(F.struct("key", "top")).alias("one")).select("one.key", "n", F.col("one.top.component").alias("main"), F.col("one.top.part").alias("n_main"))
    several = staged(several.withColumn("n_rest", F.col("n") - F.col("n_main")).withColumn("level", F.floor(F.log2("n")).cast("int")), "several")
    members = joined_evenly(now.select("key", "rep", "component"), several, "key", now.count())
    members = staged(members.select("key", "rep", (F.col("component") != F.col("main")).alias("rest"), "main", "level", "n_rest", "n_main"), "members")
    whole = F.col("level") >= F.col("least")
    met_in = joined_evenly(members, staged(met_as_one(several, members), "whole"), "main", members.count()).select(
        "rep", "rest", F.when(whole, F.col("main")).otherwise(F.col("key")).alias("cluster"), *(F.when(whole, F.col(a)).otherwise(F.col(b)).alias(b) for a, b in (("all_rest", "n_rest"), ("all_main", "n_main")))
    )
    own = F.when(F.col("rest"), dealt("rep", blocks("n_rest"))).otherwise(blocks("n_rest") + dealt("rep", blocks("n_main")))
    others = F.when(F.col("rest"), blocks("n_rest") + blocks("n_main")).otherwise(blocks("n_rest"))
    meet = met_in.distinct().select(F.col("rep").alias("id"), "cluster", own.alias("own"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
    return meet.select("id", "cluster", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each row of ``docs``.

    A document without words is a component of its own. Repeated rows give the same answer each. Rows without an id link with nothing but rows
    of the same set, have the component of those, and are kept only if none of them has an id. No rows give none.
    """
    spark = docs.sparkSession
    marks = staged(signed(docs, words, percent, id_col, text_col), "signatures")
    full = marks.where("n_shingles > 0")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = full.where("doc_id is not null").join(classes, "digest").where("doc_id = rep")
    keys = reps.select("rep", F.explode("bands").alias("key"))
    centres = keys.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre < last").select("key", "centre")
    groups = staged(keys.join(centres, "key").select("key", "rep", "centre"), "groups")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    meetings, met = with_centres(groups)
    edges = links(texts, meetings, words, percent)
    edges = edges.unionByName(links(texts, between_components(groups, met, components(edges)), words, percent))
    tied = components(edges).withColumnRenamed("id", "rep")
    answer = classes.join(tied, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    thin = marks.select("doc_id", "n_shingles", "digest")
    found = thin.where("n_shingles > 0").join(answer, "digest").select("doc_id", "n_shingles", "component_id")
    alone = thin.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all their columns."""
    kept = near_copies(docs, words, percent, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__id"]), "left_semi")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(documents(spark, sf_dir), words=3, percent=85)
