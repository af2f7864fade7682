import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from studyflow.llm import centroids, resampling, winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_ranks(texts, target, percent, seed):
    features = lambda t: [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for w in [words_of(t)] for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    own = [features(t) for _, t in texts]
    s, t = Counter(b for f in own for b in f), Counter(b for x in target for b in features(x))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in range(10_000)]
    rows = []
    for (doc, text), found in zip(texts, own):
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    there = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, row in enumerate(there[: len(there) * percent // 100]):
        row[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("percent, segment", [(5, 1_000_000), (60, 10), (100, 10)])
def test_ranks_of_a_draw(spark, docs, texts, percent, segment, monkeypatch):
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", segment)
    more = [(None, "a text without an id " * 9), (1_000_050, "x" * 200 + " Ünïcode wörds, " * 30), (1_000_051, "same text " * 20), (1_000_051, "same text " * 20)]
    df = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    target = [texts[5][1], "Same TEXT with others", None, ""]
    got = resampling.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"), percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == brute_ranks(texts + more, target, percent, 42)


def test_drawn_rows_keep_their_columns(spark, docs, texts, none):
    target = spark.createDataFrame([(texts[3][1],)], "text string")
    got = resampling.drawn(docs, target, 10)
    assert got.columns == docs.columns
    want = {r[0] for r in brute_ranks(texts, [texts[3][1]], 10, 42) if r[4]}
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == want
    assert resampling.resampled(none, target).count() == 0
    assert {r["weight"] for r in resampling.resampled(docs, none).collect()} != {0}


def test_checksums_of_joined_words():
    for n in (0, 1, 5, 62, 63, 64, 65, 1000, 70_001):
        tail = bytes(range(97, 123)) * 3000
        got = resampling.shifted(np.array([zlib.crc32(b"head")], np.uint32), np.array([n]))[0] ^ np.uint32(zlib.crc32(tail[:n]))
        assert got == zlib.crc32(b"head" + tail[:n])


def test_ties_beyond_a_segment_are_dealt_and_ranked(spark, monkeypatch):
    """One key held by all rows: the place parts it, ranks run from 1 on without gaps."""
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 100)
    df = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(" ".join(f"w{k}" for k in range(30))).alias("text")).repartition(7)
    got = resampling.resampled(df, spark.createDataFrame([("w1 w2",)], "text string"), 50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 501)) and len({r["score"] for r in got}) == 1


def brute_hits(texts, items):
    spans = []
    for item, text in items:
        w = words_of(text)
        n = min(10, len(w))
        if n:
            spans += [(tuple(w[k : k + n]), item) for k in range(len(w) - n + 1)]
    by_span, sizes = {}, {len(s) for s, _ in spans}
    for s, item in spans:
        by_span.setdefault(s, set()).add(item)
    out = []
    for doc, text in texts:
        w = words_of(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (s := tuple(w[k : k + n])) in by_span:
                    hit.update(range(k, k + n))
                    found |= by_span[s]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def test_shared_spans(spark, docs, texts):
    item = lambda n, k=4: " ".join(words_of(texts[n][1])[k : k + 25])
    items = [(10, item(3)), (9, item(3)), (100, item(8).upper()), (11, "one two"), (12, "ONE"), (13, None), (14, ""), (None, item(20)), (15, " ".join(words_of(texts[30][1])[2:9])), (16, "word5 and 5 word6 and 6 word7 and 7 word8 and 8")]
    more = [(None, "before " + item(3) + " after"), (1_000_060, item(3, 4)[:60] + " cut " + item(3)), (1_000_061, " one, two; three ")]
    df = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = winnowing.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    want = brute_hits(texts + more, items)
    assert Counter(tuple(r) for r in got.drop("items", "spans").collect()) == want
    assert sum(n for r, n in want.items() if r[-1]) > 5
    assert {r["doc_id"] for r in winnowing.clean(docs, spark.createDataFrame(items, "item_id long, text string")).collect()} == {r[0] for r in brute_hits(texts, items) if not r[-1]}


def test_spans_of_few_words_with_many_ties(spark):
    rng = np.random.default_rng(4)
    text = lambda n: " ".join("ab"[k] for k in rng.integers(0, 2, n))
    rows = [(k, text(int(rng.integers(0, 60)))) for k in range(200)] + [(900, "a " * 500)]
    items = [(k, text(int(rng.integers(8, 14)))) for k in range(6)] + [(50, "a " * 11), (51, "b a b a b a b")]
    got = winnowing.decontaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).drop("items", "spans")
    assert Counter(tuple(r) for r in got.collect()) == brute_hits(rows, items)


def test_nothing_to_find(spark, docs, texts, none):
    items = spark.createDataFrame([], "item_id long, text string")
    got = winnowing.decontaminated(docs, items).collect()
    assert len(got) == len(texts) and not any(r["contaminated"] or r["n_items"] for r in got)
    assert winnowing.decontaminated(none, spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def brute_clusters(rows, clusters, rounds, size):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) and abs(math.floor(1024 * x)) <= 2**27 for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    start = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:clusters]
    centres = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for k in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            if mine:
                centres[k] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    total, each = sum(d for _, d, _ in last), Counter()
    for _, d, k in last:
        each[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, k, d, each[k], total, digest[k]) for i, d, k in last)


def vectors(seed, n, size=8, spread=0.3, centres=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 1, (centres, size))
    return [(int(k), [float(np.float32(x)) for x in base[k % centres] + rng.normal(0, spread, size)]) for k in range(n)]


@pytest.mark.parametrize("spread, block", [(0.05, 1024), (0.6, 7)])
def test_clusters(spark, spread, block, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = vectors(1, 300, spread=spread)
    rows += [(rows[4][0], rows[4][1])] * 30 + [(None, rows[9][1]), (None, [0.0] * 8), (901, [100_000.0] * 8), (902, [-131_072.0] * 8)]
    rows += [(800, None), (801, []), (802, [1.0] * 7), (803, [1.0] * 9), (804, [None] + [1.0] * 7), (805, [math.nan] + [1.0] * 7), (806, [math.inf] * 8), (807, [1e30] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("clash")).withColumn("block", F.lit(1))
    got = centroids.clustered(df.repartition(5), clusters=6, size=8)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, 6, 10, 8)


def test_few_equal_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([(1, [0.5] * 8)], [(k, [0.5] * 8) for k in range(20)], [(1, [1.0] * 8), (2, None)], []):
        got = centroids.clustered(spark.createDataFrame(rows, schema), clusters=6, rounds=2, size=8)
        assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, 6, 2, 8)


def test_bounds_spare_evaluations_and_tables_go(spark):
    df = spark.createDataFrame(vectors(2, 2000, spread=0.02), "vec_id long, embedding array<float>")
    before = {t.name for t in spark.catalog.listTables()}
    store = centroids.Buckets(spark, 4)
    blocks = store.write(centroids.blocks_of(df, 8, "vec_id", "embedding"), "blocks")
    history, _, counts = centroids.fitted(blocks, store, 5, 10, 8, 3)
    store.drop_all()
    assert len(history) == 11 and counts[0] == 2000 and max(counts[3:]) < 500
    assert {t.name for t in spark.catalog.listTables()} == before


def test_total_displacement_is_tighter_than_summed_drifts():
    there = np.array([[0, 0], [4000, 0]], np.int64)
    away = there + [[300, 0], [0, 0]]
    bounds = centroids.Bounds([there, away, there])
    assert bounds.own[0].tolist() == [0, 0] and bounds.own[1].tolist() == [300, 0]
    state, _ = centroids.Bounds([there]).assign(np.array([[1900, 0]], "<i4"), None)
    assert len(bounds.assign(np.array([[1900, 0]], "<i4"), state)[1]) == 0
