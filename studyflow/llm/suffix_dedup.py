"""Removal of long repeats: every byte inside a string of ``LENGTH`` bytes that also starts somewhere else.

Anchors decide which suffixes have to be sorted. In each window of LENGTH bytes the gram with the least hash is its anchor, so equal windows have
the same anchor at the same place. The windows of one anchor form a segment (its text and the number of windows in it). A segment whose anchor
occurs once cannot hold a repeat; one whose whole text occurs twice is all repeats. Only the different segments that share an anchor are sorted.

They are dealt to shards by anchor, and each shard builds the suffix array of its segments (prefix doubling that refines unsorted groups only, after
Larsson and Sadakane) and the common prefixes of neighbours (Kasai, all segments in step). An anchor with more segments than a shard takes is spread
over several; what a shard leaves single is merged across shards: each sends a digest of its windows once, digests are counted, and a shard's
windows are found in the sorted list of the common ones by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.minhash import FILTER_CONF
from studyflow.llm.shared import documents, held_in_worker, mix64, settings
from studyflow.session import staged

LENGTH = 200
GRAM = 32
# Bytes of segments that a task sorts at a time, and the segments of one anchor that a shard takes.
SHARD_BYTES = 2_000_000
SHARD_SEGMENTS = 8_000
# Window starts of a document that are worked on at a time.
PART = 2**21
PLACE_BITS = 23
BASE = 0x9E3779B97F4A7C15 | 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, and a random number for each byte."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def grow(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << n.bit_length()
            inverse = pow(BASE, -1, 2**64)
            self.up, self.down = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64)))) for b in (BASE, inverse))


def gram_hashes(octets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    powers = held_in_worker("powers", Powers)
    powers.grow(len(octets))
    n = len(octets) - GRAM + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(powers.table[octets] * powers.up[: len(octets)])))
    return mix64((sums[GRAM:] - sums[:n]) * powers.down[:n])


def anchors(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment: first window, number of windows and the anchor's hash. The leftmost of equal hashes (their upper bits) is the anchor."""
    firsts, counts, grams = [], [], []
    for at in range(0, len(octets) - LENGTH + 1, PART):
        part = octets[at : at + PART + LENGTH - 1]
        hashes = gram_hashes(part)
        least = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
        width, span = LENGTH - GRAM + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = width - span
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        place = (least & np.uint64(2**PLACE_BITS - 1)).astype(np.int64)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        firsts.append(cuts + at)
        counts.append(np.diff(np.append(cuts, len(place))))
        grams.append(hashes[place[cuts]].view(np.int64))
    if not firsts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(grams)


def segments(docs: DataFrame) -> DataFrame:
    """key, first window, number of windows, anchor and digest of the segments of every document (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = ([], [], [])
            keys: list[bytes] = []
            digests: list[bytes] = []
            for k, text in enumerate(batch.column(1)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if len(raw) < LENGTH:
                    continue
                found = anchors(np.frombuffer(raw, np.uint8))
                for column, part in zip(columns, found):
                    column.append(part)
                keys += [batch.column(0)[k].as_py()] * len(found[0])
                ends = (found[0] + found[1] + LENGTH - 1).tolist()
                digests += [hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(found[0].tolist(), ends)]
            if keys:
                first, count, gram = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, first, count.astype(np.int32), gram, np.frombuffer(b"".join(digests), np.int64))], ["key", "first", "windows", "gram", "digest"])

    return docs.mapInArrow(run, "key binary, first long, windows int, gram long, digest long")


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places in order of their suffixes. Each round sorts the groups that are still tied by the rank of what follows, at double the distance."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.concatenate(([True], np.diff(symbols[order]) != 0))
    starts = np.flatnonzero(fresh)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    tied = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    step = 1
    while len(tied):
        places = order[tied]
        follow = np.where(places + step < n, rank[np.minimum(places + step, n - 1)], -1)
        key = (rank[places] << 32) | (follow + 1)
        sort = np.argsort(key, kind="stable")
        places, key = places[sort], key[sort]
        order[tied] = places
        fresh = np.concatenate(([True], np.diff(key) != 0))
        starts = np.flatnonzero(fresh)
        rank[places] = np.repeat(tied[starts], np.diff(np.append(starts, len(tied))))
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        step *= 2
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Length of the prefix that each place shares with the place before it in the order (Kasai): from one place to the next it falls by one at most.

    All segments are walked in step; each ends in a symbol of its own, so no prefix runs over an end.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    ends = np.append(starts[1:], n)
    shared = np.zeros(len(starts), np.int64)
    for t in range(int((ends - starts).max(initial=0))):
        live = np.flatnonzero(starts + t < ends)
        here = starts[live] + t
        other = before[here]
        length = np.where(other >= 0, np.maximum(shared[live] - 1, 0), 0)
        more = np.flatnonzero(other >= 0)
        while len(more):
            a, b = here[more] + length[more], other[more] + length[more]
            inside = (a < n) & (b < n)
            more, a, b = more[inside], a[inside], b[inside]
            more = more[symbols[a] == symbols[b]]
            length[more] += 1
        shared[live] = length
        out[here] = length
    return out


def repeated_windows(texts: list[bytes]) -> list[np.ndarray]:
    """For each segment, whether each of its windows also starts elsewhere in the segments."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    symbols = np.empty(int(sizes.sum()) + len(texts), np.int64)
    inside = np.ones(len(symbols), bool)
    inside[starts + sizes] = False
    symbols[inside] = np.frombuffer(b"".join(texts), np.uint8)
    symbols[starts + sizes] = 256 + np.arange(len(texts))
    order = suffix_array(symbols)
    shared = common_prefixes(symbols, order, starts)
    long = shared >= LENGTH
    follows = np.zeros(len(symbols), bool)
    follows[order[:-1]] = long[order[1:]]
    long |= follows
    return [long[a : a + max(0, s - LENGTH + 1)] for a, s in zip(starts.tolist(), sizes.tolist())]


def runs_of(marked: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of the runs of True."""
    edges = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1).tolist(), (np.flatnonzero(edges == -1) - 1).tolist()


def window_digests(text: bytes) -> list[bytes]:
    return [hashlib.blake2b(text[k : k + LENGTH], digest_size=16).digest() for k in range(len(text) - LENGTH + 1)]


RUNS = "gram long, digest long, low int, high int"


def sharded(edges: DataFrame) -> DataFrame:
    """Runs (gram, digest, low, high) of repeated windows among the segments (gram, digest, shard, body) of each (gram, shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def sorted_out() -> pa.RecordBatch:
            # Equal windows have equal anchors, so sorting several anchors' segments together adds no finds.
            rows = [(g, d, a, b) for (g, d, _), marked in zip(held, repeated_windows([h[2] for h in held])) for a, b in zip(*runs_of(marked))]
            columns = list(zip(*rows)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["gram", "digest", "low", "high"])

        last = None
        for batch in batches:
            for gram, digest, shard, body in zip(*(c.to_pylist() for c in batch.columns)):
                if (gram, shard) != last and size >= SHARD_BYTES:
                    yield sorted_out()
                    held, size = [], 0
                last = gram, shard
                held.append((gram, digest, body))
                size += len(body)
        if held:
            yield sorted_out()

    return edges.select("gram", "digest", "shard", "body").repartition("gram", "shard").sortWithinPartitions("gram", "shard").mapInArrow(run, RUNS)


def merged(edges: DataFrame) -> DataFrame:
    """Runs of windows of widely spread anchors that occur in several segments, whatever their shards: windows are counted by digest."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, digest, body in zip(*(c.to_pylist() for c in batch.columns)):
                found = window_digests(body)
                yield pa.RecordBatch.from_arrays([pa.array([gram] * len(found), pa.int64()), pa.array([digest] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], ["gram", "digest", "at", "window"])

    windows = edges.select("gram", "digest", "body").mapInArrow(spread, "gram long, digest long, at int, window binary")
    common = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    return windows.join(common, "window").select("gram", "digest", F.col("at").alias("low"), F.col("at").alias("high"))


def key_of(id_col: str, text_col: str) -> Column:
    """Key of a row: 16 bytes of a digest of its id and text. Rows that share an id, or have none, are told apart by their texts."""
    return F.substring(F.unhex(F.sha2(F.concat_ws(":", F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))), 256)), 1, 16)


def removed(texts: DataFrame) -> DataFrame:
    """key, n_removed, n_spans and kept_sha256 of documents (key, text, spans of (start, end))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                raw = (batch.column(1)[k].as_py() or "").encode("utf-8", "surrogatepass")
                spans = batch.column(2)[k].values
                spans = sorted(zip(spans.field(0).to_pylist(), spans.field(1).to_pylist()))
                kept, at, gone, count, end = hashlib.sha256(), 0, 0, 0, -1
                for a, b in spans:
                    if a > end:
                        kept.update(raw[at:a])
                        count += 1
                        at = a
                    gone += max(0, b - max(a, at))
                    at = end = max(at, b)
                kept.update(raw[at:])
                rows.append((batch.column(0)[k].as_py(), gone, count, kept.hexdigest()))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.string()))], ["key", "n_removed", "n_spans", "kept_sha256"])

    return texts.mapInArrow(run, "key binary, n_removed long, n_spans long, kept_sha256 string")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key and spans (start, end in bytes, overlapping ones apart, each once) of the repeats of every document that has some."""
    spark = docs.sparkSession
    texts = docs.select(key_of(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    every = staged(segments(texts), "segments")
    seen = staged(every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "grams").where("n > 1").select("gram")
    with settings(spark, FILTER_CONF):
        found = staged(every.join(seen, "gram"), "occurrences")
        kinds = found.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "windows")).alias("rep"))
        kinds = staged(kinds.select("gram", "digest", "n", "rep.*"), "kinds")
        shared = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        mixed = staged(kinds.join(shared, "gram"), "mixed").where("kinds > 1")
        body = F.substring(F.col("text").cast("binary"), F.col("first").cast("int") + 1, F.col("windows") + LENGTH - 1)
        shard = F.pmod(F.xxhash64("digest"), F.ceil(F.col("kinds") / SHARD_SEGMENTS))
        edges = staged(texts.join(mixed.select("gram", "digest", "kinds", "key", "first", "windows"), "key").select("gram", "digest", "kinds", shard.alias("shard"), body.alias("body")).dropDuplicates(["gram", "digest"]), "edges")
    single = sharded(edges.where(F.col("kinds") <= SHARD_SEGMENTS))
    wide = edges.where(F.col("kinds") > SHARD_SEGMENTS)
    spread = sharded(wide).unionByName(merged(wide)) if not wide.isEmpty() else None
    whole = kinds.where("n > 1").select("gram", "digest", F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))
    runs = single if spread is None else single.unionByName(spread)
    runs = staged(whole.unionByName(runs), "runs")
    spans = found.join(runs, ["gram", "digest"]).select("key", F.struct((F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("high") + LENGTH).alias("end")).alias("span"))
    return staged(spans.groupBy("key").agg(F.collect_set("span").alias("spans")), "spans")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    A null text counts as empty; what is shorter than LENGTH bytes keeps all. Every row counts as a text of its own, whatever its id: rows of equal
    texts lose them whole, if long enough, as each is a copy of the other; rows that share an id, or have none, and differ are compared like any
    others. No rows give none.
    """
    spark = docs.sparkSession
    spans = repeats(docs, id_col, text_col)
    key = key_of(id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    with settings(spark, FILTER_CONF):
        cleaned = staged(removed(docs.select(key.alias("key"), F.col(text_col).alias("text")).join(spans.where(F.size("spans") > 0), "key").select("key", "text", "spans")), "cleaned").dropDuplicates(["key"])
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return rows.join(cleaned, "key", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir))
