"""Benchmark decontamination by winnowing.

Of every ``SPAN`` consecutive words the least hash of a run of ``GRAM`` words is the fingerprint (the last one, if several are equal), so two texts
that share a span of ``SPAN`` words share the fingerprint of that span at the same place in it: no shared span is missed. An item of fewer words
is one span of its own length, with runs of at most that many words.

The fingerprints of all item spans form a bit table whose size is bounded whatever the benchmark's; it goes to the tasks that read the documents and
lets through the runs that may be a fingerprint of some item. Those that are fingerprints in their document as well are joined with the
item spans in Spark, each with the words around it, and the hit is extended to the whole span by comparing the words themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import documents, plain_words, text_slices, window_hashes, word_hashes
from studyflow.session import staged

SPAN = 10
GRAM = 5
# Bits of the table of item fingerprints: 64 for each one, within these powers of two.
BITS = (16, 27)
# Characters of text whose words are hashed at a time.
SLICE = 1_000_000
FOUND = pa.list_(pa.struct([("size", pa.int32()), ("print", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()), ("words", pa.list_(pa.string()))]))


def text_of(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "replace") for w in words]


def item_spans(items: DataFrame, span: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """item, size, print, offset (of the fingerprint in the span) and span (its words) of every span of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(text)
                size = min(span, len(words))
                if not size:
                    continue
                hashes = window_hashes(word_hashes(words), min(gram, size))
                width, starts = size - min(gram, size) + 1, len(words) - size + 1
                least, offset = hashes[:starts].copy(), np.zeros(starts, np.int64)
                for k in range(1, width):
                    lower = hashes[k : k + starts] <= least
                    least, offset = np.where(lower, hashes[k : k + starts], least), np.where(lower, k, offset)
                told = text_of(words)
                rows += [(item, size, p, o, " ".join(told[k : k + size])) for k, (p, o) in enumerate(zip(least.view(np.int64).tolist(), offset.tolist()))]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()))], ["item", "size", "print", "offset", "span"])

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "item string, size int, print long, offset int, span string")


def bit_table(spans: DataFrame) -> np.ndarray:
    """Words of 64 bits with one set for each fingerprint; at most 2^21 rows reach the driver."""
    prints = spans.select("print").distinct()
    bits = min(BITS[1], max(BITS[0], math.ceil(math.log2(prints.count() + 1)) + 6))
    place = F.col("print").bitwiseAND(F.lit((1 << bits) - 1))
    rows = prints.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(print & {(1 << bits) - 1} & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = rows.toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def fingerprints(hashes: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Whether the run at each place is the fingerprint of some ``width`` consecutive runs between ``first`` and ``last`` (both inside)."""
    own = hashes[at]
    reach = np.ones(len(at), np.int64)
    for sign in (-1, 1):
        open_ = np.ones(len(at), bool)
        for k in range(1, width):
            place = at + sign * k
            inside = (place >= first) & (place <= last)
            other = hashes[np.where(inside, place, at)]
            open_ &= inside & ((other >= own) if sign < 0 else (other > own))
            reach += open_
    return reach >= width


def marked(docs: DataFrame, table: np.ndarray, sizes: list[int], gram: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words and found (the fingerprints that an item may share, with the words around them) of every row."""
    bits = np.uint64(64 * len(table) - 1)

    def hits(texts: list[str | None]) -> Iterator[tuple[int, list[dict]]]:
        for _, part in text_slices(texts, SLICE):
            split = [plain_words(t) for t in part]
            counts = np.fromiter(map(len, split), np.int64, len(split))
            ends = np.cumsum(counts)
            owner = np.repeat(np.arange(len(split)), counts)
            words = [w for own in split for w in own]
            hashes = word_hashes(words)
            found: list[list[dict]] = [[] for _ in split]
            for g in sorted({min(gram, s) for s in sizes}):
                runs = window_hashes(hashes, g)
                place = runs & bits
                at = np.flatnonzero((table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
                at = at[at + g <= ends[owner[at]]]
                first, last = ends[owner[at]] - counts[owner[at]], ends[owner[at]] - g
                for size in (s for s in sizes if min(gram, s) == g):
                    width = size - g + 1
                    chosen = np.flatnonzero(fingerprints(runs, at, first, last, width))
                    for p, start, doc in zip(at[chosen].tolist(), first[chosen].tolist(), owner[at[chosen]].tolist()):
                        low = max(start, p - width + 1)
                        found[doc].append({"size": size, "print": int(runs[p].view(np.int64)), "at": p - start, "lead": p - low, "words": text_of(words[low : min(p + size, int(ends[doc]))])})
            yield from zip(counts.tolist(), found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(hits(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in rows], pa.int64()), pa.array([f for _, f in rows], FOUND)], ["doc_id", "n_words", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, found array<struct<size:int, print:long, at:int, lead:int, words:array<string>>>")


def occurrences(candidates: DataFrame, spans: DataFrame) -> DataFrame:
    """row, start, size and span of every item span that occurs in a document: the fingerprint's hit extended to the whole span."""
    first = F.col("lead") - F.col("offset")
    same = F.array_join(F.slice("words", F.greatest(first, F.lit(0)) + 1, F.col("span_size")), " ") == F.col("span")
    distinct = spans.select(F.col("size").alias("span_size"), F.col("print").alias("span_print"), "offset", "span").distinct()
    met = candidates.join(distinct, (F.col("print") == F.col("span_print")) & (F.col("size") == F.col("span_size"))).where((first >= 0) & same)
    return met.select("row", (F.col("at") - F.col("offset")).alias("start"), "size", "span").distinct()


def covered(spans: str) -> Column:
    """Number of places inside at least one of the (start, size) pairs of a sorted array."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(so_far, one):
        end = F.greatest(so_far["end"], one["start"] + one["size"])
        return F.struct(end.alias("end"), (so_far["n"] + end - F.greatest(so_far["end"], one["start"])).alias("n"))

    return F.aggregate(F.col(spans), zero, add, lambda x: x["n"])


def decontaminated(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items (ids as strings) and spans (start and size in words), one row for each row of ``docs``.

    Null and empty texts have no words and no hits; an item without words has no span; an item without an id marks words, but is not listed.
    Repeated rows have the same answer each; items of the same text are listed each. Other columns are not read. No rows give none.
    """
    spans = staged(item_spans(items, span, gram, item_col, item_text_col), "item-spans")
    sizes = sorted(r["size"] for r in spans.select("size").distinct().collect())
    marks = staged(marked(docs, bit_table(spans), sizes, gram, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "marked")
    none = F.array().cast("array<struct<start:int, size:int>>")
    touched = marks.where(F.size("found") > 0)
    met = staged(occurrences(touched.select("row", F.inline("found")), spans), "hits")
    places = met.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans"))
    listed = met.select("row", "span").distinct().join(spans.where("item is not null").select("span", "item").distinct(), "span").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hit = touched.select("row", "doc_id", "n_words").join(places, "row", "left").join(listed, "row", "left")
    hit = hit.select("doc_id", "n_words", F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", none).alias("spans"))
    rest = marks.where(F.size("found") == 0).select("doc_id", "n_words", F.array().cast("array<string>").alias("items"), none.alias("spans"))
    rows = hit.unionByName(rest).withColumn("n_hit", covered("spans"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items", "spans")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no span with an item, with all their columns; rows that share an id go together."""
    ids = decontaminated(docs, items, id_col=id_col, text_col=text_col).where("contaminated").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(ids["__id"]), "left_anti")


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("items", "spans")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS MATERIALIZED (SELECT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ') AS span
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS span
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT r, k, dw.n AS n, span FROM dw SEMI JOIN iw USING (span, n)),
places AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(k, k + n - 1)) AS p FROM hit) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM (SELECT DISTINCT r, n, span FROM hit) JOIN iw USING (span, n)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN listed USING (r)
"""
