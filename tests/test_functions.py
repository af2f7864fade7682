import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from studyflow.functions import genome as G
from studyflow.functions import paths as P
from studyflow.functions import stats as S
from studyflow.functions import text as T


def one(spark, expression, value="x", kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("r")).first()[0]


@pytest.mark.parametrize("n, expected", [(1, ""), (2, "A"), (3, "B"), (4, ""), (5, None)])
def test_nth(spark, n, expected):
    assert one(spark, lambda c: P.nth(c, n), "\\A\\B\\") == expected


@pytest.mark.parametrize("start, k, expected", [(1, 1, 1), (2, 1, 3), (1, 3, 5), (1, 4, 0), (-1, 1, 5), (-2, 1, 3), (-1, 3, 1), (-1, 4, 0)])
def test_instr(spark, start, k, expected):
    assert one(spark, lambda c: P.instr(c, "\\", start, k), "\\A\\B\\") == expected


def test_instr_overlapping_and_null(spark):
    assert one(spark, lambda c: P.instr(c, "aa", 1, 2), "aaa") == 2
    assert one(spark, lambda c: P.instr(c, "a"), None) is None
    assert one(spark, lambda c: P.instr(c, "a"), "") == 0


def test_ancestors_and_parent(spark):
    assert one(spark, P.ancestors, "\\A\\B\\C\\") == ["\\A\\", "\\A\\B\\", "\\A\\B\\C\\"]
    assert one(spark, lambda c: P.ancestors(c, with_self=False), "\\A\\") == []
    assert one(spark, P.parent, "\\A\\B\\") == "\\A\\"
    assert one(spark, P.parent, "\\A\\") is None
    assert one(spark, P.level, "\\A\\B\\") == 1
    assert one(spark, P.leaf_name, "\\A\\B\\") == "B"
    assert one(spark, P.collapse, "\\\\A\\\\\\B\\") == "\\A\\B\\"


@pytest.mark.parametrize("value, expected", [
    ("12", True), (" -1.5e3 ", True), (".5", True), ("5.", True), ("NaN", True), ("1d", False), ("1,5", False), ("", False), (".", False), (None, None),
])
def test_is_numeric(spark, value, expected):
    assert one(spark, T.is_numeric, value) is expected


@pytest.mark.parametrize("value, expected", [("20200131", True), ("20201331", False), ("x", False), (None, None)])
def test_is_date(spark, value, expected):
    assert one(spark, T.is_date, value) is expected


@pytest.mark.parametrize("value, expected", [
    (' "a%b&c" ', "aPCTb and c"), ("x\\y*", "xy"), (None, ""), ('"', '"'), ('a "b"', 'a "b"'), ("\t7\r", "7"),
])
def test_clean_column(spark, value, expected):
    assert one(spark, T.clean_column, value) == expected


@pytest.mark.parametrize("value, expected", [
    ("a (b", "a b"), ("a b)", "a b"), ("a (b)", "a (b)"), ("a ()", "a "), ("a ( )", "a  "), (")(", ")("), ("f(x) ()", "fx "),
])
def test_clean_parens(spark, value, expected):
    assert one(spark, T.clean_parens, value) == expected


def test_pipes_symbols_spaces(spark):
    assert one(spark, T.clean_pipes, "||a|b|") == "a-b"
    assert one(spark, lambda c: T.words_for_symbols(c, plus=True, underscore=True), "5%&a+b_c") == "5 Pct and a and b c"
    assert one(spark, T.tidy_spaces, " a  b ,c,, ") == "a b,c"
    assert one(spark, T.category_path, "A_b+C") == "A b\\C"


@pytest.mark.parametrize("side, category, expected", [
    ("A", "X+Y", "X+DATALABEL+Y"), ("B", "X+Y", "X+Y+DATALABEL"), ("A", "X+DATALABEL", "X+DATALABEL"), ("A", "X", "X"),
])
def test_label_token(spark, side, category, expected):
    assert one(spark, lambda c: T.insert_label_token(c, F.lit(side)), category) == expected


def test_subject_key(spark):
    df = spark.createDataFrame([("S", None, "1"), ("S", "N", "2")], "a string, b string, c string")
    assert [r[0] for r in df.select(T.subject_key(F.col("a"), "b", "c")).collect()] == ["S:1", "S:N:2"]


@pytest.mark.parametrize("x", [-2.5, -0.3, 0.1, 1.0, 3.0])
def test_erf_is_close_to_the_true_one(spark, x):
    assert abs(one(spark, S.erf, x, "double") - math.erf(x)) < 2e-7


@pytest.mark.parametrize("fc, mu, sd", [(1.0, 0.0, 1.0), (-3.0, 0.5, 2.0), (100.0, 0.0, 1.0), (0.0, 2.0, 1.0)])
def test_npv_expression_and_staged_column_agree(spark, fc, mu, sd):
    df = spark.createDataFrame([(fc, mu, sd)], "fc double, mu double, sd double")
    direct = df.select(S.tea_npv(F.col("fc"), F.col("mu"), F.col("sd"))).first()[0]
    staged = S.with_npv(df, F.col("fc"), F.col("mu"), F.col("sd")).first()["npv"]
    expected = max(1 - NormalDist(mu, sd).cdf(abs(fc)), 1e-5)
    assert direct == pytest.approx(expected, abs=1e-6) and staged == pytest.approx(direct, abs=1e-12)


def test_npv_without_spread_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0), (1.0, 0.0, None)], "fc double, mu double, sd double")
    assert [r["npv"] for r in S.with_npv(df, F.col("fc"), F.col("mu"), F.col("sd")).collect()] == [None, None]


def test_zscore_edges(spark):
    df = spark.createDataFrame([(5.0, 1.0, 0.0), (9.0, 1.0, 1.0), (-9.0, 1.0, 1.0), (2.0, 1.0, None)], "x double, m double, s double")
    assert [r[0] for r in df.select(S.zscore(F.col("x"), F.col("m"), F.col("s"))).collect()] == [0.0, 2.5, -2.5, None]


def test_genome_expressions(spark):
    assert one(spark, lambda c: G.info_attribute(c, "VC"), "RS=1;VC=SNV;X") == "SNV"
    assert one(spark, lambda c: G.info_attribute(c, "VC"), "RS=1") == ""
    assert one(spark, G.chromosome_code, "XY") == "25"
    assert one(spark, lambda c: G.alleles(G.genotype(c, {"2": "NN"})), "2") == " 0 0"
