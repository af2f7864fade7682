"""Quality rules: plain counts and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into ``BUCKETS`` buckets. The raw multinomial counts all documents; the trusted one counts all that are labelled
good. A document's score is the mean, over its n-grams, of the log ratio of the two; it is held against one fixed threshold, which leaves all but
``LOST`` of the trusted documents in. No document is drawn by chance, and no count stops growing with the input: scores are counted on a grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import documents, mix64, settings, window_hashes, word_hashes
from studyflow.session import staged

BUCKETS = 2**14
# Of the trusted documents, the share that may score below the threshold.
LOST = 0.001
# How far below the lowest trusted scores the threshold lies, in log odds for each n-gram.
MARGIN = 0.05
# Width of a step of the grid on which the trusted scores are counted. Scores are means of log ratios, so the grid has some ten thousand steps at most.
STEP = 0.001
# N-grams of ratio 0 added to each document, so that a few odd words do not decide about a short one.
PRIOR = 20
# The Bloom filter of the trusted ids, and the same plan whether they are few or many.
FILTER_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}
SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    """Bucket of every word and of every pair of neighbours."""
    return (np.concatenate((mix64(hashes), window_hashes(hashes, 2))) % np.uint64(BUCKETS)).astype(np.int64)


def words_of(text: str | None) -> tuple[bytes, list[bytes]]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw, raw.split()


def plain_counts(raw: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    octets = np.frombuffer(raw, np.uint8)
    symbols = int(SYMBOLS[octets].sum())
    chars = int(((octets & 0xC0) != 0x80).sum()) - raw.count(b" ") - sum(raw.count(c) for c in (b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 5:
        _, code, count = np.unique(window_hashes(hashes, 5), return_inverse=True, return_counts=True)
        starts = np.concatenate(((count[code] > 1).astype(np.int64), np.zeros(5, np.int64)))
        edges = np.cumsum(starts)
        edges[5:] -= edges[:-5].copy()
        repeated = int((edges[: len(words)] > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """N-grams by bucket over all rows: each task adds up its own and sends at most ``BUCKETS`` rows; so does the sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(buckets_of(word_hashes(words_of(text.as_py())[1])), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the two smoothed multinomials by bucket; all 0 if either is empty."""
    if not trusted.sum() or not raw.sum():
        return np.zeros(BUCKETS)
    p = lambda c: (c + 1) / (c.sum() + BUCKETS)
    return np.log(p(trusted)) - np.log(p(raw))


def score(hashes: np.ndarray, ratio: np.ndarray) -> float:
    found = ratio[buckets_of(hashes)]
    return float(found.sum() / (len(found) + PRIOR))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the documents labelled good; one that is labelled twice comes twice."""
    return labels.where("quality = 1").select("doc_id")


def trusted_texts(texts: DataFrame, good: DataFrame) -> DataFrame:
    """The texts of the documents labelled good. Their ids go to the scan as a Bloom filter, so hardly any other text is shuffled, at any size."""
    return texts.join(good, "doc_id", "left_semi").select("text")


def threshold_of(scores: DataFrame) -> float:
    """Score below which a document goes, from all trusted scores; with none, no document does."""
    found = scores.groupBy(F.floor(F.col("score") / STEP).cast("long").alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy("step").toArrow()
    if not found.num_rows:
        return -np.inf
    upto = np.cumsum(found["n"].to_numpy())
    return float(found["step"].to_numpy()[np.searchsorted(upto, LOST * upto[-1], side="right")] * STEP - MARGIN)


def judged(docs: DataFrame, ratio: np.ndarray, threshold: float) -> DataFrame:
    """The counts, base_failed, kept and score of every row. A null text counts as none, and fails as too short; repeated rows give the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                raw, words = words_of(text.as_py())
                hashes = word_hashes(words)
                counts = plain_counts(raw, words, hashes)
                failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
                found = score(hashes, ratio)
                rows.append((*counts, failed, not failed and found >= threshold, found))
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double")


def ruled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judged`` with the ratios and the threshold of all documents that ``labels`` (doc_id, quality) calls good.

    Without such documents every ratio is 0 and the base rules alone decide. Labels of unknown documents count nowhere; rows without an id are
    judged, but never trusted.
    """
    texts, good = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), trusted_ids(labels)
    with settings(docs.sparkSession, FILTER_CONF):
        trusted = bucket_counts(trusted_texts(texts, good))
    ratio = ratios(trusted, bucket_counts(texts.select("text")))
    rows = staged(judged(texts, ratio, -np.inf), "scores")
    least = threshold_of(rows.join(good, "doc_id", "left_semi").select("score"))
    return rows.withColumn("kept", F.col("kept") & (F.col("score") >= F.lit(least)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
