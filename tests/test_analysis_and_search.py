import pytest
from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.operators import analysis as AL
from studyflow.operators import ontology as O
from studyflow.operators import qc as Q
from studyflow.operators import search as SE
from studyflow.operators import tree as TR


def test_import_drops_rows_without_content(spark):
    df = spark.createDataFrame([('"gse1"', '"a"'), ("gse2", '""'), ("gse3", None)], "study_id string, title string")
    assert rows(AL.import_external(df)) == [("GSE1", "a")]


def test_validation_checks_both_means(spark):
    df = spark.createDataFrame([("a", "0.01", "x", ".", "-2", "5", "3"), ("a", "0.01", "1", "1", "2", "5", "bad"), ("a", "n/a", "1", "1", "2", "1", "2")],
                               "analysis_id string, preferred_pvalue string, raw_pvalue string, adjusted_pvalue string, fold_change string, lsmean_1 string, lsmean_2 string")
    out = AL.validate_results(df).select("raw_pvalue", "adjusted_pvalue", "min_lsmean", "max_lsmean")
    assert rows(out) == [(1.0, 1.0, None, None), (None, None, 3.0, 5.0)]
    assert tuple(AL.dropped_results(df).first()) == (1, 3)


@pytest.mark.parametrize("fc, p, npv, m1, m2, expected", [
    (2.0, 0.01, 0.5, 30.0, 1.0, 1), (1.0, 0.01, 0.5, 30.0, 1.0, 0), (None, 0.01, 0.5, 30.0, 1.0, 1), (-2.0, None, 0.01, None, None, 1),
    (2.0, None, 0.2, 30.0, 1.0, 0), (2.0, 0.01, 0.5, 1.0, 1.0, 0), (2.0, None, None, 30.0, 1.0, 0), (2.0, 0.01, 0.5, None, 30.0, 1),
])
def test_significance(spark, fc, p, npv, m1, m2, expected):
    df = spark.createDataFrame([(fc, p, npv, m1, m2)], "fc double, p double, n double, a double, b double")
    flag = AL.significance(*[F.col(c) for c in ("fc", "p", "n", "a", "b")], F.lit(1.0), F.lit(0.05), F.lit(20.0))
    assert df.select(flag).first()[0] == expected


def test_tags_and_invalid_terms(spark):
    records = spark.createDataFrame([("s", 1, "Blood", "Aspirin; Foo;")], "study_id string, analysis int, tissue string, treatment string")
    taxonomy = spark.createDataFrame([(5, "BLOOD"), (6, "aspirin")], "term_id int, term_name string")
    tags, invalid = AL.tag_terms(records, ["study_id", "analysis"], {"tissue": None, "treatment": ";"}, taxonomy)
    assert rows(tags) == [("s", 1, 5, "TISSUE:BLOOD"), ("s", 1, 6, "TREATMENT:ASPIRIN")] and rows(invalid) == [("S", "treatment", "Foo")]


def test_lineage_climbs(spark):
    taxonomy = spark.createDataFrame([(1, "root"), (2, "mid"), (3, "leaf")], "term_id int, term_name string")
    relations = spark.createDataFrame([(3, 2), (2, 1)], "child_id int, parent_id int")
    assert rows(AL.lineage(taxonomy, relations, spark.createDataFrame([(9, 3)], "rec int, term_id int")).select("term_name")) == [("leaf",), ("mid",), ("root",)]


def test_project_file(spark):
    lines = spark.createDataFrame([("f", "title = a=b "), ("f", "x=."), ("f", "note")], "file_name string, line string")
    assert rows(AL.project_rows(lines, ["title", "x"])) == [("f", "a=b", None)]


MESH = "\nRECTYPE = D\nMH = Asthma\nENTRY = Bronchial Asthma|T047\nPRINT ENTRY = no\nMN = C08.127\nMN = C20.5\nUI = D001249\n"


def test_mesh(spark, tmp_path):
    (tmp_path / "m.txt").write_text("*NEWRECORD" + MESH + "*NEWRECORD" + MESH.replace("Asthma", "Other").replace("C08.127", "D01").replace("D001249", "D9").replace("C20.5", "D02"))
    records = O.read_records(spark, str(tmp_path), O.MESH_RECORD)
    assert rows(O.mesh_headings(records, ["C08"])) == [("D001249", "Asthma", "C20.5")]
    assert O.mesh_headings(records).count() == 2
    assert rows(O.mesh_synonyms(records)) == [("Asthma", "Bronchial Asthma"), ("Other", "Bronchial Other")]


def test_ontology_terms_keep_the_last_block(spark, tmp_path):
    (tmp_path / "go.obo").write_text("format: 1\n\n[Term]\nid: GO:1\nname: one\n\n[Term]\nid: GO:2\nname: two\n")
    assert rows(O.ontology_terms(O.read_records(spark, str(tmp_path), O.TERM_RECORD))) == [("GO:1", "one"), ("GO:2", "two")]


def test_gene_info(spark):
    lines = spark.createDataFrame([("#Format: x",), ("9606\t1\tA1BG\t-\tA1B|ABG\tx\tx\tx\tglyco",), ("9606\t2\tA2M\t-\t-\tx\tx\tx\tmacro",), ("7\t3\tQ\t-\tz\tx\tx\tx\tq",)], "line string")
    genes, synonyms = O.gene_info(lines, ["9606"])
    assert genes.count() == 2 and rows(synonyms.select("symbol", "synonym")) == [("A1BG", "A1B"), ("A1BG", "ABG")]


def test_gene_lists_over_lines(spark, tmp_path):
    (tmp_path / "l.txt").write_text('ING:1\tPath, one\tx\ty\t"207, 5\n 9"\nING:2\tTwo\tx\ty\t207\n')
    genes = spark.createDataFrame([("207", "AKT1")], "gene_id string, symbol string")
    definitions, members, rejects = O.gene_list_pathways(O.pathway_records(spark, str(tmp_path)), genes)
    assert rows(definitions) == [("ING:1", "Path one"), ("ING:2", "Two")] and members.count() == 2 and rows(rejects.select("gene_id")) == [("5",), ("9",)]


def test_marker_inside_a_title_starts_no_record(spark, tmp_path):
    (tmp_path / "l.txt").write_text("ING:1\tWNT SIGNALING: beta\tx\ty\t207\nING:2\tTwo\tx\ty\t207\n")
    definitions = O.gene_list_pathways(O.pathway_records(spark, str(tmp_path)), spark.createDataFrame([("207", "AKT1")], "gene_id string, symbol string"))[0]
    assert rows(definitions) == [("ING:1", "WNT SIGNALING: beta"), ("ING:2", "Two")]


def test_lineage_of_six_levels_and_a_cycle(spark):
    taxonomy = spark.createDataFrame([(i, f"t{i}") for i in range(1, 8)], "term_id int, term_name string")
    relations = spark.createDataFrame([(i, i + 1) for i in range(1, 7)] + [(7, 6)], "child_id int, parent_id int")
    assert rows(AL.lineage(taxonomy, relations, spark.createDataFrame([(9, 1)], "rec int, term_id int")).select("term_id")) == [(i,) for i in range(1, 8)]


def test_overall_design(spark):
    df = spark.createDataFrame([("e", "i", "N/A", "f"), ("N/A", None, None, "f"), (None, None, "x", None)], "a string, b string, c string, d string")
    out = df.select(O.overall_design(*[F.col(c) for c in "abcd"]))
    assert len(spark.createDataFrame([("x" * 3000, "N/A", "N/A", "f")], "a string, b string, c string, d string").select(O.overall_design(*[F.col(c) for c in "abcd"])).first()[0]) == 3000
    assert [r[0] for r in out.collect()] == ["e Inclusion Criteria: i", "f", " Exclusion Criteria: x"]


def test_keywords_terms_and_taxonomy(spark):
    index = spark.createDataFrame([(3, "asthma", "DISEASE")], "keyword_id long, keyword string, category string")
    grown = SE.add_keywords(index, spark.createDataFrame([("ASTHMA",), ("Flu",)], "name string"), "DISEASE")
    assert rows(grown) == [(3, "asthma", "DISEASE"), (4, "Flu", "DISEASE")]
    terms = SE.keyword_terms(grown, spark.createDataFrame([(4, "influenza"), (4, "FLU")], "keyword_id long, synonym string"))
    assert rows(terms) == [(3, "ASTHMA", 1, 6), (4, "FLU", 1, 3), (4, "INFLUENZA", 2, 9)]
    taxonomy, relations = SE.add_taxonomy_terms(spark.createDataFrame([(1, "Root")], "term_id long, term_name string"), spark.createDataFrame([("a", "ROOT"), ("b", "A")], "term string, parent string"))
    ids = {r["term_name"]: r["term_id"] for r in taxonomy.collect()}
    assert set(rows(relations)) == {(ids["a"], 1), (ids["b"], ids["a"])}


def test_reconcile_and_compare(spark):
    source = spark.createDataFrame([("s", "a", "1.0"), ("s", "b", "x"), ("s", "c", "."), ("s", "d", "4"), ("t", "a", "9")], "subject string, property string, value string")
    target = spark.createDataFrame([("s", "a", "1.0004"), ("s", "b", "y"), ("s", "c", "5"), ("t", "a", "9.1")], "subject string, property string, value string")
    assert {(r["subject"], r["property"]): r["state"] for r in Q.reconcile(source, target, ["subject", "property"], "value").collect()} == {
        ("s", "a"): "equal", ("s", "b"): "different", ("s", "d"): "missing", ("t", "a"): "different"}
    repeated = spark.createDataFrame([("s", "2"), ("s", "10"), ("s", "10")], "subject string, value string")
    stored = spark.createDataFrame([("s", "10"), ("s", "2")], "subject string, value string")
    assert {r["state"]: r["n_values"] for r in Q.state_counts(Q.compare(repeated, stored, ["subject"], "value")).collect()} == {"equal": 2, "missing": 1}


def test_audit_trail_counts_without_a_second_pass(spark, tmp_path):
    trail = Q.AuditTrail(spark, "j")
    trail.write("a", spark.range(5), str(tmp_path / "a"))
    with pytest.raises(Exception):
        trail.write("b", spark.range(3).select(F.raise_error(F.lit("no"))), str(tmp_path / "b"))
    assert [(r["step_name"], r["records"], r["status"]) for r in trail.report().orderBy("step").collect()] == [("a", 5, "Done"), ("b", None, "FAIL")]


def test_levels_without_a_name_have_no_node(spark):
    df = spark.createDataFrame([(1, "p1", "t"), (2, "p1", None), (3, None, None)], "sample int, platform string, tissue string")
    assert rows(TR.counts_by_level(df, "\\b\\", ["platform", "tissue"], "sample")) == [("\\b\\", 3), ("\\b\\p1\\", 2), ("\\b\\p1\\t\\", 1)]


def test_counts_by_level(spark):
    df = spark.createDataFrame([("G1", "Blood", 1), ("G1", "Liver", 2), ("G1", "Blood", 3)], "platform string, tissue string, sample int")
    assert rows(TR.counts_by_level(df, "/b/".replace("/", "\\"), ["platform", "tissue"], "sample")) == [("\\b\\", 3), ("\\b\\G1\\", 3), ("\\b\\G1\\Blood\\", 2), ("\\b\\G1\\Liver\\", 1)]


def test_terms_are_never_the_broadcast_side(spark):
    records = spark.createDataFrame([("s", k, "red") for k in (1, 1, 2)], "study_id string, k int, platform string")
    taxonomy = spark.createDataFrame([("Red", 7)], "term_name string, term_id int")
    tags = AL.tag_terms(records, ["study_id", "k"], {"platform": None}, taxonomy)[0]
    plan = tags._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert "HashAggregate" not in plan[plan.index("REPARTITION_BY_COL") :]
    assert sorted(tuple(r) for r in tags.collect()) == [("s", 1, 7, "PLATFORM:RED"), ("s", 2, 7, "PLATFORM:RED")]
