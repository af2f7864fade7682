import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from studyflow.llm import exact_dedup, minhash, suffix_dedup
from studyflow.llm.shared import components
from studyflow.session import settings


def test_components_of_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(41, 50), (50, 60), (60, 41), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, 41: 41, 50: 41, 60: 41}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_copies(docs, texts):
    groups = defaultdict(list)
    for doc, text in texts:
        groups[text or ""].append(doc)
    want = {(d, max(groups[t or ""]), len(groups[t or ""]), d == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in texts}
    assert Counter(tuple(r) for r in exact_dedup.copies(docs).collect()) == Counter(want)


def test_exact_copies_stay_once_with_their_columns(docs, texts):
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    want = {}
    for doc, text in texts:
        want[text or ""] = max(doc, want.get(text or "", 0))
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(want.values())


def test_state_outlives_a_stream(spark, tmp_path):
    path, work = str(tmp_path / "in"), str(tmp_path / "work")
    first = exact_dedup.fingerprints(spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string"))
    first.write.parquet(path)
    stream = lambda: exact_dedup.stream_of(spark, path, first.schema)
    assert exact_dedup.remember(stream(), work).count() == 2
    exact_dedup.fingerprints(spark.createDataFrame([(3, "x"), (4, "z")], "doc_id long, text string")).write.mode("append").parquet(path)
    state = exact_dedup.remember(stream(), work)
    assert sorted((r["keep_id"], r["group_size"]) for r in state.collect()) == [(2, 1), (3, 2), (4, 1)]


def test_a_shared_digest_is_told_apart_by_the_bytes(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "long one")], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: exact_dedup.F.lit("ab"))
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.copies(df).collect()}
    assert got == {(1, 3, 2, False), (3, 3, 2, True), (2, 2, 1, True), (4, 4, 1, True)}


def test_no_rows(none):
    assert exact_dedup.copies(none).count() == 0
    assert minhash.near_copies(none).count() == 0
    assert suffix_dedup.without_repeats(none).count() == 0


def brute_near(texts, words, percent):
    sets = {}
    for d, t in texts:
        w = (t or "").encode().lower().split()
        sets[d] = ({tuple(w)} if len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}) if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter(p for ds in holders.values() for p in combinations(sorted(ds), 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_copies(docs, texts, words, percent):
    got = minhash.near_copies(docs, words, percent).collect()
    assert len(got) == len(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute_near(texts, words, percent)
    kept = minhash.without_near_copies(docs, words, percent)
    assert kept.columns == docs.columns


def test_clusters_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(40):
        words = list(base)
        for j in range(k % 5):
            words[(k * 7 + j * 31) % 120] = f"x{k}_{j}"
        rows.append((100 - k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_copies(df, 3, 85).collect()}
    assert got == brute_near(rows, 3, 85)


def test_members_of_a_split_group_that_only_tie_with_each_other(spark, monkeypatch):
    """Chains away from the centre: pairs under the threshold to the centre, tied to one another, in groups over many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = np.random.default_rng(3)
    rows, base = [], [f"w{i}" for i in range(200)]
    for family in range(6):
        words = list(base)
        for j in rng.choice(200, 8, replace=False):
            words[j] = f"f{family}_{j}"
        for member in range(9):
            own = list(words)
            own[int(rng.integers(200))] = f"m{family}_{member}"
            rows.append((1000 - len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_copies(df, 3, 85).collect()}
    want = brute_near(rows, 3, 85)
    assert got == want and len({c for _, c, _ in want.values()}) == 6


def test_half_alike_documents_are_not_linked(spark):
    """Boilerplate: many documents at a similarity of 0.3 to 0.5 share bands by chance, and none is linked."""
    rng = np.random.default_rng(4)
    shared = [f"s{i}" for i in range(100)]
    rows = []
    for k in range(1500):
        own = [f"o{k}_{i}" for i in range(int(rng.integers(50, 110)))]
        rows.append((k, " ".join(shared + own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_copies(df, 3, 85)
    assert got.where("kept").count() == 1500


def test_band_groups_of_the_same_sets_meet_once(spark, monkeypatch):
    """Twelve groups drawn from one large group, and a large component with an outsider in each of forty small groups, which stay apart."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = np.random.default_rng(5)
    component = {r: 0 if r < 60 else 500 if 500 <= r < 700 else r for r in (*range(100), *range(500, 700), *range(1000, 1040))}
    keys = {k: sorted(rng.choice(100, 60, replace=False).tolist()) for k in range(12)}
    keys |= {100 + k: [500 + 5 * k, 501 + 5 * k, 1000 + k] for k in range(40)}
    groups = spark.createDataFrame([(k, r, reps[0]) for k, reps in keys.items() for r in reps], "key long, rep long, centre long")
    tied = spark.createDataFrame([(r, c) for r, c in component.items() if c in (0, 500)], "id long, component long")
    got = minhash.between_components(groups, spark.createDataFrame([], "rep long, met long"), tied).collect()
    at = defaultdict(dict)
    for r in got:
        assert r["id"] not in at[r["cluster"], r["low"], r["high"]]
        at[r["cluster"], r["low"], r["high"]][r["id"]] = r["own"]
    meet = {(a, b) for (_, low, high), own in at.items() for a, b in combinations(sorted(own), 2) if low == high or own[a] != own[b]}
    for reps in keys.values():
        assert {(a, b) for a, b in combinations(reps, 2) if component[a] != component[b]} <= meet
    rows = lambda rest, main: rest * (-(-rest // 4) + -(-main // 4)) + main * -(-rest // 4)
    apart = sum(rows(sum(r >= 60 for r in keys[k]), sum(r < 60 for r in keys[k])) for k in range(12))
    assert sum(r["id"] < 100 for r in got) == rows(40, 60) < apart / 4
    assert sum(r["id"] >= 500 for r in got) == 40 * (2 + 2)


def test_only_texts_that_meet_are_shuffled(spark, monkeypatch, tmp_path):
    """The join of the texts with their meetings puts a Bloom filter on the scan of the texts, with bits by the number of members."""
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(map(str, rng.integers(0, 10**6, 200)))) for k in range(2000)] + [(5000 + k, f"the same text here {'again ' * 30}{k % 2}") for k in range(8)]
    spark.createDataFrame(rows, "id long, text string").coalesce(1).write.parquet(f"{tmp_path}/texts")
    meetings = spark.createDataFrame([(5000 + k, 5000, 0, 0, 0) for k in range(8)] + [(None, 5000, 0, 0, 0)], "id long, cluster long, own int, low int, high int")
    plans, staged = [], minhash.staged
    monkeypatch.setattr(minhash, "staged", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or staged(df, name))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        edges = minhash.links(spark.read.parquet(f"{tmp_path}/texts"), meetings, 3, 85)
    assert "might_contain" in plans[-1] and "bloom_filter_agg" in plans[-1]
    assert {r["id"]: r["component"] for r in components(edges).collect()} == {5000 + k: 5000 + k % 2 for k in range(8)}
    assert minhash.filter_conf(10**9)["spark.sql.optimizer.runtime.bloomFilter.numBits"] == str(2**26)


def test_circulant_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate((a[:1500], rng.integers(0, 2**63, 500, dtype=np.uint64)))
    same = (minhash.signature(a, 512) == minhash.signature(b, 512)).mean()
    assert abs(same - 1500 / 2500) < 0.08


def brute_repeats(texts):
    raw = [(t or "").encode() for _, t in texts]
    seen = Counter(r[i : i + 200] for r in raw for i in range(len(r) - 199))
    out = []
    for (d, _), r in zip(texts, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if seen[r[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((d, len(r), sum(gone), sum(g and not p for p, g in zip(b"\0" + gone, gone)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [8000, 1])
def test_long_repeats(docs, texts, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", shard)
    got = [tuple(r) for r in suffix_dedup.without_repeats(docs).collect()]
    assert Counter(got) == Counter(brute_repeats(texts))


@pytest.mark.parametrize("shard", [8000, 1])
def test_repeats_of_rows_that_share_an_id_or_have_none(spark, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", shard)
    rng = np.random.default_rng(5)
    new = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    parts = [new(600) for _ in range(4)]
    mixed = lambda *own: new(own[0]) + "".join(p[own[1] :] + new(50) for p in parts) + new(own[0])
    rows = [(None, mixed(300, 0)), (None, mixed(500, 90)), (None, new(900)), (7, mixed(250, 0)), (7, mixed(450, 150)), (7, parts[1] + new(300)), (8, mixed(310, 200)), (9, new(100) + parts[0][:350]), (None, None), (None, "short")]
    rows += [(3, new(700))] * 2 + [(None, new(800))] * 3
    got = [tuple(r) for r in suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert Counter(got) == Counter(brute_repeats(rows))


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(20):
        parts = [bytes(rng.integers(97, 99, rng.integers(1, 40), dtype=np.uint8)) for _ in range(4)]
        symbols = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64), 256 + k) for k, p in enumerate(parts)])
        starts = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])[:-1]))
        order = suffix_dedup.suffix_array(symbols)
        suffix = [symbols[k:].tolist() for k in range(len(symbols))]
        assert order.tolist() == sorted(range(len(symbols)), key=lambda k: suffix[k])
        shared = suffix_dedup.common_prefixes(symbols, order, starts)
        for a, b in zip(order[:-1], order[1:]):
            n = next((k for k, (x, y) in enumerate(zip(suffix[a], suffix[b])) if x != y), min(len(suffix[a]), len(suffix[b])))
            assert shared[b] == n


def test_anchors_cover_every_window_once_and_agree():
    rng = np.random.default_rng(3)
    core = rng.integers(97, 100, 900, dtype=np.uint8)
    a = np.concatenate((rng.integers(97, 123, 333, dtype=np.uint8), core, rng.integers(97, 123, 50, dtype=np.uint8)))
    first, count, gram = suffix_dedup.anchors(a)
    assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and first[-1] + count[-1] == len(a) - 199
    own = np.repeat(gram, count)[333 : 333 + 701]
    first, count, gram = suffix_dedup.anchors(core)
    assert (np.repeat(gram, count) == own).all()
