"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

The trees are fitted on the driver to a bounded sample of labelled documents (``SAMPLE``); their flat arrays go to the tasks, which walk all
rows and trees of a batch at once. Only statistics of the text are inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studyflow.llm.boosting import Trees, fit
from studyflow.llm.shared import documents, window_hashes, word_hashes

# Labelled documents that a fit takes at most, on average (chosen by a hash of the id).
SAMPLE = 20_000
KEPT_FROM = 0.3

CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "comma", "exclaim", "symbol", "bar", "quote", "bracket", "other", "beyond_ascii")
FEATURES = (
    *(f"share_{c}" for c in CLASSES), "log_words", "log_chars", "mean_word", "longest_word", "distinct_words", "top_word", "repeated_windows", "top_window", "log_lines", "mean_line",
    "equal_lines", "lines_with_stop", "mean_sentence", "entropy", "capital_words", "short_words",
)


def _byte_classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.int64)
    table[128:] = CLASSES.index("beyond_ascii")
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"), ("blank", " \t\r\x0b\x0c"), ("newline", "\n"),
                        ("stop", ".?"), ("comma", ",;:"), ("exclaim", "!"), ("symbol", "#*$%&<>@^~"), ("bar", "|"), ("quote", "\"'"), ("bracket", "()[]{}")):
        table[[ord(c) for c in chars]] = CLASSES.index(name)
    return table


BYTE_CLASS = _byte_classes()


def statistics(text: str | None) -> np.ndarray:
    """The features of one whole text; all are defined for an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(len(FEATURES))
    size = len(raw)
    if not size:
        return out
    octets = np.frombuffer(raw, np.uint8)
    counts = np.bincount(octets, minlength=256)
    classes = np.bincount(BYTE_CLASS, counts, len(CLASSES))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    hashes = word_hashes(words)
    _, each = np.unique(hashes, return_counts=True) if words else (None, np.ones(1))
    _, windows = np.unique(window_hashes(hashes, 5), return_counts=True)
    share = counts[counts > 0] / size
    initial = np.frombuffer(b"".join(w[:1] for w in words), np.uint8)
    out[:] = (
        *(classes / size), np.log1p(len(words)), np.log1p(size), lengths.mean(), lengths.max(), len(each) / n, each.max() / n, windows[windows > 1].sum() / n, windows.max(initial=0) / n, np.log1p(len(lines)), size / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), sum(x.rstrip()[-1:] in b".!?\"" for x in lines) / max(1, len(lines)), n / (1 + classes[CLASSES.index("stop")] + classes[CLASSES.index("exclaim")]),
        -(share * np.log(share)).sum(), ((initial >= 65) & (initial <= 90)).sum() / n, (lengths <= 3).sum() / n,
    )
    return out


def held_out(id_col: str):
    """One fifth of the ids, kept from every fit; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample of the labelled documents that are not held out; rows without a label do not count."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    share = min(1.0, sample / max(1, labels.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < round(share * 2**20)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(chosen), "doc_id").select("text", F.col("quality").cast("double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    table = rows.mapInArrow(run, "x array<double>, y double").toArrow()
    x = table["x"].combine_chunks()
    return np.asarray(x.values if isinstance(x, pa.ListArray) else x.combine_chunks().values).reshape(-1, len(FEATURES)), table["y"].to_numpy()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    return fit(*labelled_statistics(docs, labels, sample))


def scored(docs: DataFrame, model: Trees) -> DataFrame:
    """All columns of ``docs`` and ``__score``; tasks walk the trees for a few hundred rows at a time."""
    names, fields = docs.columns, T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            scores = []
            for low in range(0, batch.num_rows, 512):
                scores.append(model.score(np.stack([statistics(t.as_py()) for t in batch.column(at).slice(low, 512)])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0))], [*names, "__score"])

    return docs.mapInArrow(run, fields)


def rate(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; null and empty texts get the score of an empty one, repeated rows the same score."""
    rows = scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= KEPT_FROM).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Trees) -> DataFrame:
    """The rows that the classifier keeps, with all their columns."""
    return scored(docs, model).where(F.col("__score") >= KEPT_FROM).drop("__score")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return rate(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
