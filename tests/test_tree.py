from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.operators import tree as TR

PATHS = st.lists(st.lists(st.sampled_from("ABC"), min_size=1, max_size=4), min_size=1, max_size=8)
LOOSE = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def encode(parts):
    return "\\" + "\\".join(parts) + "\\"


def frame(spark, paths):
    return spark.createDataFrame([(encode(p),) for p in paths], "path string")


@LOOSE
@given(paths=PATHS)
def test_fill_is_complete_and_idempotent(spark, paths):
    filled = TR.fill_ancestors(frame(spark, paths))
    expected = {encode(p[:i]) for p in paths for i in range(1, len(p) + 1)}
    assert {r[0] for r in filled.collect()} == expected
    assert rows(TR.fill_ancestors(filled)) == rows(filled)
    assert TR.missing_ancestors(filled).count() == 0


@LOOSE
@given(facts=st.lists(st.tuples(st.lists(st.sampled_from("AB"), min_size=1, max_size=3), st.integers(1, 4)), min_size=1, max_size=12))
def test_counts_match_brute_force(spark, facts):
    df = spark.createDataFrame([(encode(p), m) for p, m in facts], "path string, patient_num int")
    expected = {}
    for p, m in facts:
        for i in range(1, len(p) + 1):
            expected.setdefault(encode(p[:i]), set()).add(m)
    got = {r["path"]: r["patient_count"] for r in TR.counts(df).collect()}
    assert got == {k: len(v) for k, v in expected.items()}


def test_move_and_move_back(spark):
    tree = TR.node_rows(TR.fill_ancestors(frame(spark, [list("ABC"), list("AD"), list("X")])))
    moved = TR.move(tree, "\\A\\", "\\N\\M\\")
    assert {r["path"]: r["level"] for r in moved.collect()} == {"\\N\\M\\": 1, "\\N\\M\\B\\": 2, "\\N\\M\\B\\C\\": 3, "\\N\\M\\D\\": 2, "\\X\\": 0}
    assert rows(TR.move(moved, "\\N\\M\\", "\\A\\").select("path", "level")) == rows(tree.select("path", "level"))


def test_rename_changes_whole_parts_only(spark):
    tree = spark.createDataFrame([("\\A\\B\\", "B"), ("\\A\\BB\\", "BB"), ("\\A\\B\\C\\", "C")], "path string, name string")
    assert rows(TR.rename(tree, "B", "Z", F.lit(True), ["path"])) == [("\\A\\BB\\", "BB"), ("\\A\\Z\\", "Z"), ("\\A\\Z\\C\\", "C")]


def test_prefix_is_literal(spark):
    tree = spark.createDataFrame([("\\A_1\\", "FA"), ("\\AX1\\", "FA")], "path string, attributes string")
    assert rows(TR.set_visible(tree, "\\A_1\\", False)) == [("\\AX1\\", "FA"), ("\\A_1\\", "FH")]


def test_hide_delete_and_security(spark):
    tree = spark.createDataFrame([("\\A\\", "A", "FA", "S"), ("\\A\\B\\", "B", "LA", "S"), ("\\X\\", "SECURITY", "FA", None)], "path string, name string, attributes string, source string")
    counted = spark.createDataFrame([("\\A\\", 2), ("\\A\\B\\", 0)], "path string, patient_count long")
    hidden = TR.hidden(TR.hide_uncounted(tree, counted))
    assert [r["path"] for r in hidden.collect()] == ["\\A\\B\\"]
    assert rows(TR.delete(tree, tree.where("name = 'A'").select("path"), subtree=True).select("path")) == [("\\X\\",)]
    tokens = spark.createDataFrame([("S", "EXP:S")], "study_id string, token string")
    assert {r["name"]: r["token"] for r in TR.secured(tree, tokens).collect()} == {"A": "EXP:S", "B": "EXP:S", "SECURITY": "EXP:PUBLIC"}


def test_leaf_flags(spark):
    tree = spark.createDataFrame([("\\S\\", "LA", "N"), ("\\S\\a\\", "FA", "N"), ("\\O\\", "FA", "N")], "path string, attributes string, data_type string")
    assert rows(TR.set_leaf_flags(tree, "\\S\\", highlight=True)) == [("\\O\\", "FA", "N"), ("\\S\\", "FAJ", "T"), ("\\S\\a\\", "LA", "N")]


def test_counts_and_hiding_keep_to_their_scope(spark):
    tree = spark.createDataFrame([("\\A\\", "A", "FA"), ("\\A\\x\\", "x", "LA"), ("\\A\\y\\", "y", "LH"), ("\\A\\z\\", "z", "LA"), ("\\B\\", "B", "FA"), ("\\B\\x\\", "x", "LA")], "path string, name string, attributes string")
    facts = spark.createDataFrame([("\\A\\x\\", 1), ("\\A\\x\\", 2), ("\\A\\x\\", 9), ("\\A\\y\\", 3), ("\\B\\x\\", 4)], "path string, patient_num long")
    patients = spark.createDataFrame([(1, "a:1"), (2, "a:S:2"), (3, "a:3"), (4, "b:4")], "patient_num long, subject_key string")
    counted = TR.scoped_counts(tree, facts, patients, "\\A\\")
    assert rows(counted.select("path", "patient_count")) == [("\\A\\", 1), ("\\A\\x\\", 1)]
    assert rows(TR.hidden(TR.hide_uncounted(tree, counted, scope="\\A\\")).select("path")) == [("\\A\\y\\",), ("\\A\\z\\",)]
    again, fresh = TR.show_again(tree, "\\A\\", facts, patients)
    assert TR.hidden(again).count() == 0 and rows(fresh.select("path", "patient_count")) == [("\\A\\", 2), ("\\A\\x\\", 1), ("\\A\\y\\", 1)]
