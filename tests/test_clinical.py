import pytest
from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.operators import clinical as C
from studyflow.operators import melt as ML

COLUMNS = ["site", "subj", "visit", "test", "result", "sex"]
TOP_NODE = "\\P\\S\\"
MAPPING = "category_cd string, column_number int, data_label string, label_source string"


def raw(spark):
    return spark.createDataFrame([
        (1, "S1", "1", "V1", "Height", "180", "M"), (2, "S1", "2", None, "Weight%", ".", "F"), (3, "", "3", "V2", "Height", "bad", "F"),
    ], "rec int, site string, subj string, visit string, test string, result string, sex string")


def mapping(spark, side="4A"):
    return spark.createDataFrame([
        ("", 1, "SITE_ID", None), ("", 2, "SUBJ_ID", None), ("", 3, "VISIT_NAME", None), ("", 4, "OMIT", None),
        ("Vitals+Body", 5, "\\", side), ("Demo", 6, "Sex", None),
    ], MAPPING)


def test_melt_with_dynamic_labels(spark):
    out = ML.by_mapping(raw(spark), mapping(spark), "rec", COLUMNS)
    assert rows(out) == rows(spark.createDataFrame([
        (1, 5, "S1", "1", "V1", "Height", "180", "Vitals+DATALABEL+Body"), (1, 6, "S1", "1", "V1", "Sex", "M", "Demo"),
        (2, 6, "S1", "2", None, "Sex", "F", "Demo"), (3, 5, None, "3", "V2", "Height", "bad", "Vitals+DATALABEL+Body"), (3, 6, None, "3", "V2", "Sex", "F", "Demo"),
    ], out.schema))
    assert ML.by_mapping(raw(spark), mapping(spark, "4B"), "rec", COLUMNS).where("column_number = 5").first()["category_cd"] == "Vitals+Body+DATALABEL"
    assert ML.by_mapping(raw(spark), mapping(spark), "rec", COLUMNS, preserve_nulls=True).count() == 6


def test_melt_plan_does_not_grow_with_the_mapping(spark):
    def lines(rules):
        return len(ML.by_mapping(raw(spark), rules, "rec", COLUMNS)._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert lines(mapping(spark)) == lines(spark.createDataFrame(mapping(spark).collect() * 9, MAPPING))


def test_mapping_rejects_and_details(spark):
    rules = spark.createDataFrame([
        ("", 2, "SUBJ_ID", None), ("", 3, "VISIT_DATE", None), ("", 1, "SAMPLE_CD", None), (None, 5, "Height", None), ("A", 99, "x", None), ("A", 0, "y", None), ("A+B", 5, "\\", "77"), ("A+B", 5, "\\", None), ("A", 6, "Sex", None),
    ], MAPPING)
    assert sorted(r["reason"] for r in ML.mapping_rejects(rules, len(COLUMNS)).collect()) == ["CATEGORY", "COLUMN", "COLUMN", "LABEL_SOURCE", "LABEL_SOURCE"]
    out = ML.by_mapping(raw(spark), rules, "rec", COLUMNS, details=True)
    assert {r["data_label"] for r in out.collect()} == {"Sex"} and {r["visit_date"] for r in out.where("rec = 1").collect()} == {"V1"}
    with pytest.raises(Exception, match="no subject column"):
        ML.by_mapping(raw(spark), rules.where("data_label <> 'SUBJ_ID'"), "rec", COLUMNS).collect()


def test_word_map_and_exclusions(spark):
    words = spark.createDataFrame([(6, "M", "Male")], "column_number int, from_value string, to_value string")
    listed = spark.createDataFrame([(5, "bad")], "column_number int, value string")
    out = ML.by_mapping(raw(spark), mapping(spark), "rec", COLUMNS, words, listed)
    assert sorted((r["rec"], r["data_value"]) for r in out.where("column_number = 6").collect()) == [(1, "Male"), (2, "F")]


def test_exclusions_of_columns_beyond_the_file_match_nothing(spark):
    listed = spark.createDataFrame([(5, "bad"), (6, "M"), (0, "F"), (99, "F"), (None, "F")], "column_number int, value string")
    assert rows(ML.without_listed(raw(spark), "rec", COLUMNS, listed).select("rec")) == [(2,)]


def test_sequences_wider_than_the_mask_stay_whole(spark):
    df = spark.createDataFrame([(7,), (1000,), (100001,), (None,)], "n long")
    assert [r[0] for r in df.select(ML.mask_sequence(F.col("n"), 3)).collect()] == ["007", "1000", "100001", "-1"]


def test_date_parsing_statuses(spark):
    df = spark.createDataFrame([("2020/01/02", "07:30"), ("2020/01/02 08:15", "07:30"), ("x", None), (None, "07:30"), (None, None)], "d string, t string")
    out = ML.parse_dates(df, "d", ["yyyy/MM/dd HH:mm", "yyyy/MM/dd"], "t").select(F.date_format("visit_date", "HH:mm"), "visit_date_status")
    assert [tuple(r) for r in out.collect()] == [("07:30", "OK"), ("08:15", "OK"), (None, "BAD_DATE"), (None, "TIME_WITHOUT_DATE"), (None, "MISSING")]


LANDING = "study_id string, site_id string, subject_id string, visit_name string, data_label string, data_value string, category_cd string"


def landing(spark):
    return spark.createDataFrame([
        ("T1", None, "1", "Week 1", "Weight", "70.5", "Vitals+VISITNAME+DATALABEL"), ("T1", None, "1", "Week 2", "Weight", "71", "Vitals+VISITNAME+DATALABEL"),
        ("T1", None, "2", "Week 1", "Weight", "n/a", "Vitals+VISITNAME+DATALABEL"), ("T1", None, "1", "Only", "Sex", "M", "Demo+Sex"),
        ("T1", "A", "2", "only", "Sex", "F", "Demo+Sex"), ("T1", None, "1", None, "Age", "44", "Demo"), ("T1", "A", "2", None, "Age", "x", "Demo"),
        ("T1", None, "1", None, "Note", None, "Demo"),
    ], LANDING)


def test_working_rows(spark):
    out = {(r["usubjid"], r["data_label"], r["visit_name"]): r for r in C.infer_types(C.standardise(landing(spark))).collect()}
    assert len(out) == 7
    assert out[("T1:1", "Weight", "Week 2")]["data_type"] == "N"  # all values of that visit are numbers
    assert out[("T1:1", "Weight", "Week 1")]["data_type"] == "T"
    sex = out[("T1:A:2", "Sex", None)]  # one visit in the category: dropped; label repeats the path: trimmed
    assert (sex["category_cd"], sex["category_path"]) == ("Demo", "Demo")


def test_leaf_nodes_and_facts(spark):
    loaded = C.load(
        landing(spark), "\\P\\T1\\", spark.createDataFrame([], "patient_num long, subject_key string, age int, sex string, race string"),
        spark.createDataFrame([], "concept_cd long, concept_path string, name string"), "T1",
    )
    nodes = {r["leaf_node"] for r in loaded["nodes"].collect()}
    assert nodes == {
        "\\P\\T1\\Vitals\\Week 1\\Weight\\70.5\\", "\\P\\T1\\Vitals\\Week 1\\Weight\\n/a\\", "\\P\\T1\\Vitals\\Week 2\\Weight\\",
        "\\P\\T1\\Demo\\Sex\\M\\", "\\P\\T1\\Demo\\Sex\\F\\", "\\P\\T1\\Demo\\Age\\44\\", "\\P\\T1\\Demo\\Age\\x\\",
    }
    people = {r["subject_key"]: (r["age"], r["sex"]) for r in loaded["patients"].collect()}
    assert people == {"T1:1": (44, "M"), "T1:2": (0, "Unknown"), "T1:A:2": (0, "F")}
    facts = loaded["facts"].collect()
    assert len(facts) == 7 and {r["number_value"] for r in facts if r["value_type"] == "N"} == {71.0}
    assert loaded["duplicate_keys"].count() == 0 and loaded["mixed_visits"].count() == 0


def test_reload_is_idempotent(spark):
    empty = spark.createDataFrame([], "patient_num long, subject_key string, age int, sex string, race string")
    people = C.demographics(C.add_keys(landing(spark))).withColumnRenamed("usubjid", "subject_key")
    once = C.merge_patients(empty, people, "T1")
    assert rows(C.merge_patients(once, people, "T1")) == rows(once)


def test_dropped_patient_stays_while_a_sample_uses_it(spark):
    old = spark.createDataFrame([(1, "T1:1", 4, "F", None), (2, "T1:2", 5, "M", None), (3, "T2:9", 6, "M", None)], "patient_num long, subject_key string, age int, sex string, race string")
    new = spark.createDataFrame([("T1:3", 7, None, "r")], "subject_key string, age int, sex string, race string")
    used = spark.createDataFrame([(2,)], "patient_num long")
    out = {r["subject_key"]: r["patient_num"] for r in C.merge_patients(old, new, "T1", used).collect()}
    assert out == {"T1:2": 2, "T1:3": 4, "T2:9": 3}


def test_parent_leaf_conflict(spark):
    nodes = spark.createDataFrame([("\\A\\B\\",), ("\\A\\B\\C\\",), ("\\A_B\\",), ("\\AxB\\C\\",)], "leaf_node string")
    assert rows(C.parent_leaf_conflicts(nodes)) == [("\\A\\B\\",)]
    assert C.without_lower_nodes(nodes).count() == 3


def test_pedigree_patients(spark):
    ped = spark.createDataFrame([("G12T", "1"), ("NA13_2", "2"), ("14", "9")], "individual_id string, sex_code string")
    assert rows(C.pedigree_patients(ped, "F")) == [("F:12", "Male"), ("F:13", "Female"), ("F:14", "Unknown")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_not_dealt_by_their_few_columns(spark):
    cells = ML.to_cells(raw(spark), "rec", COLUMNS)
    records = ML.record_columns(cells, mapping(spark), "rec", {"SITE_ID": "site", "SUBJ_ID": "subj"})
    assert "hashpartitioning(column_number" not in plan_of(records)
    assert rows(records) == [(1, "S1", "1"), (2, "S1", "2"), (3, "", "3")]
    parts = ML.joined_parts(cells, spark.createDataFrame([(4, "label", 2), (1, "label", 1)], "column_number int, target string, seq int"), "rec")
    assert "hashpartitioning(column_number" not in plan_of(parts)
    assert rows(parts.select("rec", "label"))[0] == (1, "S1 Height")


@pytest.mark.parametrize("name", ["c02_flatten_special_columns", "c03_label_from_header", "c04_label_from_column", "c05_multi_source_parts"])
def test_wide_queries_deal_by_record_only(spark, name, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(1, 7, "O", 1.5, "5-LOW"), (2, 8, "P", 2.5, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, "A"), (8, "B")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    out = entry.queries()[name](spark, str(tmp_path))
    assert "hashpartitioning(column_number" not in plan_of(out)
    assert {r["rec"] for r in out.collect()} == {1, 2}


def landing_tables(spark, path):
    from datetime import date

    spark.createDataFrame([(k, k % 3, "OFP"[k % 3], 1.5 * k, date(2020 + k % 2, 1, 1), "5-LOW") for k in range(12)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(k, k, "BUILDING") for k in range(3)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(3)], "n_nationkey int, n_name string").write.parquet(f"{path}/nation.parquet")


@pytest.mark.parametrize("name", ["c12_paths_and_keys", "c13_c14_pipes_and_parens", "c15_single_visits", "c16_trim_repeated_label", "c17_repeated_visits", "c18_c19_symbols_and_spaces"])
def test_near_unique_groups_are_combined_after_the_shuffle(spark, name, tmp_path):
    import __spark_entry__ as entry

    landing_tables(spark, tmp_path)
    out = entry.queries()[name](spark, str(tmp_path))
    plan = plan_of(out)
    shuffled = plan[plan.index("hashpartitioning(site_id") :]
    assert "HashAggregate" not in shuffled
    assert sum(r["n_rows"] for r in out.collect()) == 12 * 4 + 8


def test_single_visits_are_counted_not_sorted_for(spark):
    landing = spark.createDataFrame([("A", "Visit 1"), ("A", "VISIT 1"), ("B", "x"), ("B", "y"), ("C", None), (None, "z")] * 2, "category_cd string, visit_name string")
    assert "SortAggregate" not in plan_of(C.single_visits(landing))
    assert rows(C.drop_single_visits(landing)) == rows(spark.createDataFrame([("A", None), ("A", None), ("B", "x"), ("B", "y"), ("C", None), (None, "z")] * 2, "category_cd string, visit_name string"))


def test_facts_are_combined_after_the_shuffle(spark):
    typed = spark.createDataFrame(
        [("S:1", "S", "A", "Lab", None, "N", "1"), ("S:1", "S", "A", "Lab", None, "N", "1.0"), ("S:1", "S", "A", "Lab", None, "N", "1"), ("S:2", "S", "A", "Kind", None, "T", "x")],
        "usubjid string, study_id string, category_path string, data_label string, visit_name string, data_type string, data_value string",
    ).withColumn("category_cd", F.col("category_path"))
    nodes = C.leaf_nodes(typed, TOP_NODE)
    concepts = spark.createDataFrame([(1, f"{TOP_NODE}A\\Lab\\"), (2, f"{TOP_NODE}A\\Kind\\x\\")], "concept_cd long, concept_path string")
    patients = spark.createDataFrame([(7, "S:1"), (8, "S:2")], "patient_num long, subject_key string")
    out = C.facts(typed, patients, nodes, concepts, TOP_NODE)
    plan = plan_of(out)
    assert plan[: plan.index("Exchange")].count("HashAggregate") == 2
    assert sorted(rows(out)) == [(7, 1, "S", "N", "E", 1.0), (8, 2, "S", "T", "x", None)]
