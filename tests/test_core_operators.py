import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.operators import grouping as G
from studyflow.operators import joins as J
from studyflow.operators import merge as M
from studyflow.operators import reshape as RS
from studyflow.operators import routing as R
from studyflow.operators.numbering import number_rows, surrogate_ids


def skewed(spark, n=3000):
    """One key holds a third of all rows, one is null."""
    rnd = random.Random(7)
    data = [(("hot" if i % 3 == 0 else (None if i % 3 == 1 and i % 7 == 0 else f"k{i % 50}")), i, rnd.gauss(0, 10)) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, id long, v double")


@pytest.mark.parametrize("sliced", [True, False])
def test_numbering_restarts_per_key_and_is_dense(spark, sliced):
    data, df = skewed(spark)
    out = number_rows(df, ["id"], ["k"], F.floor(F.col("id") / 100) if sliced else None).collect()
    assert len(out) == len(data)
    for key in {k for k, _, _ in data}:
        got = sorted((r["id"], r["row_num"]) for r in out if r["k"] == key)
        assert [n for _, n in got] == list(range(1, len(got) + 1))


@pytest.mark.parametrize("sliced", [True, False])
def test_global_numbering_follows_the_order(spark, sliced):
    data, df = skewed(spark)
    out = number_rows(df, ["v", "id"], slice_by=F.floor(F.col("v")) if sliced else None).collect()
    expected = {i: n for n, (_, i, _) in enumerate(sorted(data, key=lambda r: (r[2], r[1])), 1)}
    assert {r["id"]: r["row_num"] for r in out} == expected


def test_surrogate_ids_are_dense_and_reproducible(spark):
    df = spark.createDataFrame([(f"n{i}", i) for i in range(500)], "n string, i long")
    first = {r["n"]: r["id"] for r in surrogate_ids(df, ["n"], "id", 10).collect()}
    again = {r["n"]: r["id"] for r in surrogate_ids(df.repartition(7), ["n"], "id", 10).collect()}
    assert first == again and sorted(first.values()) == list(range(11, 511))


def test_exact_median_with_hot_and_null_groups(spark):
    data, df = skewed(spark)
    got = {r["k"]: (r["median"], r["top"]) for r in G.exact_median(df, ["k"], "v", extra={"top": F.max("v")}).collect()}
    for key in {k for k, _, _ in data}:
        values = [v for k, _, v in data if k == key]
        assert got[key][0] == pytest.approx(statistics.median(values)) and got[key][1] == max(values)


def test_exact_median_spreads_the_distinct_values_of_a_group(spark):
    hot = [((i * 7919) % 5001) / 8 for i in range(5000)]
    groups = {"hot": hot, None: hot[:7], "two": [1.5, float("inf")], "ties": [2.0] * 6 + [3.0] * 6, "one": [4.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("none", None)], "k string, v double")
    out = G.exact_median(df, ["k"], "v")
    assert {r["k"]: r["median"] for r in out.collect()} == {k: statistics.median(vs) for k, vs in groups.items()}
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "median(" not in plan and "percentile" not in plan
    assert [r["median"] for r in G.exact_median(df.where("k = 'hot'"), [], "v").collect()] == [statistics.median(hot)]


def test_list_by_key_parts_make_the_whole_list(spark):
    data, df = skewed(spark, 900)
    out = G.list_by_key(df, ["k"], F.col("id").cast("string"), ["id"], ";", 20, F.floor(F.col("id") / 50)).collect()
    assert max(r["n_items"] for r in out) == 20
    hot = ";".join(r["items"] for r in sorted((r for r in out if r["k"] == "hot"), key=lambda r: r["part"]))
    assert hot == ";".join(str(i) for k, i, _ in data if k == "hot")


def test_null_safe_and_case_insensitive_joins(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    assert rows(J.null_safe(a, b, ["k"])) == [("x", 2, 20), (None, 1, 10)]
    c = spark.createDataFrame([(" X ", 5)], "n string, c int")
    assert rows(J.no_case(a, c, "k", "n").select("a", "c")) == [(2, 5)]


def test_lookup_takes_the_first_match_and_a_default(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x", 2, "later"), ("x", 1, "first")], "n string, o int, v string")
    assert rows(J.lookup(a, b, {"k": "n"}, {"v": "none"}, ["o"])) == [("x", "first"), ("y", "none")]


def test_constants_row_must_be_one_row(spark):
    a = spark.createDataFrame([(1,)], "a int")
    two = spark.createDataFrame([(1,), (2,)], "c int")
    with pytest.raises(Exception):
        J.with_constants(a, two, ["c"]).collect()


KEYED = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 3)), max_size=10)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=KEYED, new=KEYED)
def test_diff_and_apply_give_the_new_side(spark, old, new):
    frames = [spark.createDataFrame(list(d.items()), "k int, v int") for d in (old, new)]
    difference = M.diff(*frames, ["k"], ["v"])
    assert {r["k"]: r["v"] for r in M.apply(difference).collect()} == new
    flags = {r["k"]: r["flag"] for r in difference.collect()}
    for k in set(old) | set(new):
        expected = "new" if k not in old else "deleted" if k not in new else "identical" if old[k] == new[k] else "changed"
        assert flags[k] == expected
    merged = {r["k"]: r["v"] for r in M.upsert(*frames, ["k"], ["v"], ["v"]).collect()}
    assert merged == {k: (new[k] if new.get(k) is not None else old.get(k)) for k in set(old) | set(new)}


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = M.upsert(old, new, ["k"], ["v"])
    assert rows(M.upsert(once, new, ["k"], ["v"])) == rows(once) == [(1, "a"), (2, "c"), (3, "d")]


def test_split_sends_unknown_to_the_false_branch(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    yes, no = R.split(df, F.col("a") > 2)
    assert rows(yes) == [(3,)] and rows(no) == [(1,), (None,)]


def test_unpivot_then_columns_gives_the_matrix_back(spark):
    df = spark.createDataFrame([("p1", "1", "2"), ("p2", "3", "")], "`ID` string, `a.CEL` string, b string")
    long = RS.unpivot_matrix(df, ["ID"])
    assert rows(long) == [("p1", "a.CEL", "1"), ("p1", "b", "2"), ("p2", "a.CEL", "3")]
    back = RS.rows_to_columns(long, ["ID"], "sample", "intensity", ["a.CEL", "b"])
    assert rows(back) == [("p1", "1", "2"), ("p2", "3", None)]


def test_zip_lists_routes(spark):
    df = spark.createDataFrame([("p", "g1///g2", "s1 /// s2"), ("q", "g1", "s1///s2"), ("AFFX-1", "g", "s")], "probe string, g string, s string")
    result, reject, discard = RS.zip_lists(df, {"g": "gene", "s": "symbol"}, "///", F.startswith("probe", F.lit("AFFX")))
    assert rows(result) == [("p", "g1", "s1"), ("p", "g2", "s2")]
    assert [r["probe"] for r in reject.collect()] == ["q"] and [r["probe"] for r in discard.collect()] == ["AFFX-1"]


def test_most_frequent_and_reduce(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 9), ("a", "y", 3.0, 4), ("a", "y", 5.0, 7)], "k string, v string, n double, rec int")
    assert rows(G.most_frequent(df, ["k"], "v", "top")) == [("a", "y", 2)]
    assert rows(G.reduce_duplicates(df, ["k"], "n", "MEAN", "rec")) == [("a", 3.0, 4)]
