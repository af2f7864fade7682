"""Importance resampling towards a target distribution, with exact ranks by parallel sorting by regular sampling.

Words and their runs of two and three fall into hashed buckets. The gain of a bucket is the log ratio of its share in the target texts and its
share in all documents, in whole thousandths; the gains are one array, and a document's weight is the sum of its features' entries. A fixed
draw of Gumbel noise for each id turns the highest scores into a sample without replacement in proportion to the weights.

The order is found without a global sort on one machine: every partition is a run sorted in itself, which gives every ``step``-th of its rows
as a regular sample; the sorted samples give the splitters of about equal segments. Rows of each segment are counted; the running counts are
the ranks at which the segments begin. Only the segments that the draw reaches are exchanged, merged in the task that takes them (Spark's
sort within a partition, which spills), and numbered from their first rank on. A key never ties, as the place of the row is its last part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import documents, held_in_worker, plain_words, text_slices
from studyflow.session import staged

BUCKETS = 10_000
RUN = 3
# Characters of text whose words are looked up at a time.
SLICE = 1_000_000
# Words whose checksum a worker remembers; it starts anew when full.
REMEMBERED = 400_000
# Rows of a segment, and regular samples that reach the driver, at most (on average; a run adds one sample).
SEGMENT_ROWS = 1_000_000
SAMPLES = 2**20
KEY = np.dtype([("score", np.int64), ("id", np.int64), ("place", np.int64)])
NO_ID = -(2**63)


def _step(x: np.ndarray) -> np.ndarray:
    """The register of CRC-32 after one more byte of zero."""
    bits = x & np.uint32(255)
    for _ in range(8):
        bits = (bits >> np.uint32(1)) ^ np.where(bits & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return (x >> np.uint32(8)) ^ bits


def _short_shifts(most: int) -> np.ndarray:
    """One table of 4 x 256 entries for each number of zero bytes below ``most``; the register is linear in its bytes."""
    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    rows = []
    for _ in range(most):
        rows.append(now)
        now = _step(now)
    return np.stack(rows)


SHORT = _short_shifts(65)


def _through(tables: np.ndarray, base: np.ndarray | int, x: np.ndarray) -> np.ndarray:
    flat = tables.reshape(-1)
    out = flat[base + (x & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= flat[base + 256 * k + ((x >> np.uint32(8 * k)) & np.uint32(255))]
    return out


def shifted(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What the checksum ``crc`` of some bytes adds to that of the same bytes followed by ``zeros`` more."""
    out = _through(SHORT, np.minimum(zeros, 63) * 1024, crc)
    rest = np.maximum(zeros - 63, 0)
    if rest.any():
        power = SHORT[1]
        for k in range(int(rest.max()).bit_length()):
            on = np.flatnonzero((rest >> k) & 1)
            out[on] = _through(power, 0, out[on])
            power = _through(power, 0, power.reshape(-1)).reshape(4, 256)
    return out


class Checksums(dict):
    """CRC-32 of a word and its length, in one number."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = zlib.crc32(word) | len(word) << 32
        return found


def feature_buckets(words: list[bytes], owner: np.ndarray, known: Checksums) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of run: the bucket of the run that starts at each word, and whether the run lies in one text."""
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    crc, size = (codes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (codes >> np.uint64(32)).astype(np.int64)
    blank = np.uint32(zlib.crc32(b" "))
    run, out = crc, [(crc % np.uint32(BUCKETS), np.ones(len(words), bool))]
    for n in range(1, RUN):
        run = run[: max(0, len(words) - n)]
        run = shifted(_through(SHORT, 1024, run) ^ blank, size[n:]) ^ crc[n:]
        out.append((run % np.uint32(BUCKETS), owner[: len(run)] == owner[n:]))
    return out


def sliced_buckets(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(place of the first text, number of words of each text, buckets) of runs of whole texts."""
    known = held_in_worker("word checksums", Checksums)
    for first, part in text_slices(texts, SLICE):
        if len(known) > REMEMBERED:
            known.clear()
        split = [plain_words(t) for t in part]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        yield first, sizes, feature_buckets([w for words in split for w in words], np.repeat(np.arange(len(split)), sizes), known)


def bucket_counts(texts: DataFrame, text_col: str) -> np.ndarray:
    """Features of all rows by bucket; a task gives one row for each bucket that it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, found in sliced_buckets(batch.column(0).to_pylist()):
                for bucket, inside in found:
                    total += np.bincount(bucket[inside], minlength=BUCKETS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    rows = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    total_raw, total_target = int(raw.sum()), int(target.sum())
    ratio = ((t + 1) * (total_raw + BUCKETS) / ((s + 1) * (total_target + BUCKETS)) for s, t in zip(raw.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, seed: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, features, weights = batch.column(0).to_pylist(), [], [], []
            for _, sizes, found in sliced_buckets(batch.column(1).to_pylist()):
                ends = np.cumsum(sizes)
                each = np.zeros(int(sizes.sum()) + 1, np.int64)
                for bucket, inside in found:
                    each[1 : len(bucket) + 1] += np.where(inside, gain[bucket], 0)
                running = np.cumsum(each)
                words.append(sizes)
                features.append(sum(np.maximum(sizes - k, 0) for k in range(RUN)))
                weights.append(running[ends] - running[ends - sizes])
            if ids:
                weight = np.concatenate(weights)
                score = weight + np.array([noise(seed, i) for i in ids], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (np.concatenate(words), np.concatenate(features), weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def keys_of(batch: pa.RecordBatch) -> np.ndarray:
    """Sort keys of rows: highest score first, then the smaller id (none before all), then the place."""
    out = np.empty(batch.num_rows, KEY)
    at = batch.schema.get_field_index
    out["score"] = -batch.column(at("score")).to_numpy(zero_copy_only=False)
    out["id"] = batch.column(at("doc_id")).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    out["place"] = batch.column(at("place")).to_numpy(zero_copy_only=False)
    return out


def splitters(rows: DataFrame, total: int, segments: int) -> np.ndarray:
    """Keys that part all rows into ``segments`` of about equal size, from the regular samples of the sorted runs.

    With r runs a segment holds at most total / segments + r * step rows.
    """
    step = max(1, total // segments**2, -(-total // SAMPLES))

    def regular(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = step // 2
        for batch in batches:
            chosen = np.arange(left, batch.num_rows, step)
            left = (chosen[-1] + step if len(chosen) else left) - batch.num_rows
            yield batch.take(pa.array(chosen, pa.int64()))

    runs = rows.select("score", "doc_id", "place").sortWithinPartitions(F.desc("score"), F.asc("doc_id"), F.asc("place"))
    table = runs.mapInArrow(regular, "score long, doc_id long, place long").toArrow().combine_chunks()
    samples = np.sort(np.concatenate([keys_of(b) for b in table.to_batches()] or [np.zeros(0, KEY)]))
    return samples[[len(samples) * k // segments for k in range(1, segments)]] if len(samples) else samples


def ranked(rows: DataFrame, total: int, drawn: int) -> DataFrame:
    """``rows`` (doc_id, score and a unique place among others) with their ``rank`` from 1 on, highest score first; null beyond ``drawn``."""
    spark, names = rows.sparkSession, rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    segments = max(spark.sparkContext.defaultParallelism, -(-total // SEGMENT_ROWS))
    cuts = splitters(rows, total, segments)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.searchsorted(cuts, keys_of(batch), side="right"), pa.int32())], [*names, "segment"])

    dealt = rows.mapInArrow(deal, f"{schema}, segment int")
    sizes = np.zeros(segments, np.int64)
    for row in dealt.groupBy("segment").count().collect():
        sizes[row["segment"]] = row["count"]
    before = np.cumsum(sizes) - sizes
    reached = int((before < drawn).sum())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            segment = batch.column(len(names)).to_numpy()
            rank = np.zeros(batch.num_rows, np.int64)
            for s, at, n in zip(*np.unique(segment, return_index=True, return_counts=True)):
                rank[at : at + n] = before[s] + seen.get(s, 0) + np.arange(1, n + 1)
                seen = {s: seen.get(s, 0) + n}
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(rank, pa.int64(), mask=rank > drawn)], [*names, "rank"])

    merged = dealt.where(F.col("segment") < reached).repartition(segments, "segment").sortWithinPartitions("segment", F.desc("score"), F.asc("doc_id"), F.asc("place"))
    return merged.mapInArrow(number, f"{schema}, rank long").unionByName(dealt.where(F.col("segment") >= reached).drop("segment").withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank, one row for each row of ``docs``.

    The documents of at least ``least_words`` words take part; of N such ``percent`` in 100 (rounded down) get ranks. Null and empty texts have no
    features, weight 0 and no rank. A null id draws its noise as an empty one and comes first among ties. Repeated rows take part each and have
    ranks of their own. Other columns are not read. No rows give none.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    rows = staged(weighed(docs, gain, seed, id_col, text_col).withColumn("place", F.monotonically_increasing_id()), "weights")
    there = F.col("n_words") >= least_words
    total = rows.where(there).count()
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    short = rows.where(~there).withColumn("rank", F.lit(None).cast("long")).select(columns)
    if not total:
        return short
    return ranked(rows.where(there), total, total * percent // 100).select(columns).unionByName(short)


def drawn(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; rows that share an id come together."""
    ids = resampled(docs, target, percent, seed, id_col=id_col, text_col=text_col).where("rank is not null").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(ids["__id"]), "left_semi")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
