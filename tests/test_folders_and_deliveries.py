import uuid

import pytest
from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.functions import paths as P
from studyflow.operators import analysis as AL
from studyflow.operators import annotation as AN
from studyflow.operators import assay as A
from studyflow.operators import melt as ML
from studyflow.operators import numbering
from studyflow.operators import ontology as O
from studyflow.operators import snp as SN
from studyflow.operators import tree as TR
from studyflow.operators import vcf as V
from studyflow.operators.numbering import number_rows
from studyflow.sources import headed as H
from studyflow.sources import study_folder as SF
from studyflow.sources import tables as TB
from studyflow.streaming import folder_load


@pytest.fixture
def small_splits(spark):
    """Text files are read in splits of a few dozen bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "50"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_places_follow_the_file_over_its_splits(spark, tmp_path, small_splits):
    put(tmp_path, "a.txt", *[f"line {k:04d}" for k in range(300)])
    lines = H.placed_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5
    assert [r["line"] for r in lines.orderBy("place").collect()] == [f"line {k:04d}" for k in range(300)]


def test_study_folders_load_each_file_once(spark, tmp_path):
    root, target = tmp_path / "root", str(tmp_path / "out")
    study = root / "Public" / "Oncology" / "GSE1"
    put(study / "ClinicalData", "c.txt", "SUBJ\tAGE\tSEX", "s1\t40\tF", "s2\t\tM")
    put(study / "ClinicalDataToUpload", "more.txt", "SUBJ\tBMI", "s1\t22")
    put(study / "ClinicalData", "_DONE_old.txt", "SUBJ\tX", "s9\t1")
    put(study / "ExpressionData", "GSE1_R.txt", "ID_REF\tG1\tG2", "p1\t1.5\tnull", "p2\t2\t3")
    put(study / "Notes", "readme.txt", "not loaded")
    first = SF.load(spark, str(root), target)
    assert rows(first.select(F.substring_index("file_path", "/", -1), "kind", "study", "node", "n_rows", "load")) == [
        ("GSE1_R.txt", "expression", "GSE1", "\\Public\\Oncology\\GSE1\\", 3, 1), ("c.txt", "clinical", "GSE1", "\\Public\\Oncology\\GSE1\\", 4, 1), ("more.txt", "clinical", "GSE1", "\\Public\\Oncology\\GSE1\\", 1, 1)]
    put(study / "SampleMap", "map.txt", "GSE1\t\ts1\tG1\tGPL1\tblood\t\t\tA+B")
    put(study / "ClinicalData", "empty.txt", "SUBJ\tAGE")
    assert rows(SF.load(spark, "file:" + str(root), target).select("kind", "n_rows", "load")) == [("clinical", 0, 2), ("samples", 6, 2)]
    assert SF.load(spark, str(root), target).count() == 0
    assert rows(SF.loaded_rows(spark, target, "clinical").select("item", "column", "value", "load")) == [
        ("s1", "AGE", "40", 1), ("s1", "BMI", "22", 1), ("s1", "SEX", "F", 1), ("s2", "AGE", "", 1), ("s2", "SEX", "M", 1)]
    assert rows(SF.loaded_rows(spark, target, "expression").select("item", "column", "value", "data_type")) == [("p1", "G1", "1.5", "R"), ("p2", "G1", "2", "R"), ("p2", "G2", "3", "R")]


def test_an_unfinished_load_is_repeated(spark, tmp_path):
    root, target = tmp_path / "root", str(tmp_path / "out")
    put(root / "S" / "ClinicalData", "c.txt", "SUBJ\tAGE", "s1\t40")
    lost = spark.createDataFrame([("file:/gone", "x", "y", "z")], "file_path string, item string, column string, value string")
    lost.write.parquet(f"{target}/clinical/load=1")  # rows of a call that died before its manifest
    assert SF.load(spark, str(root), target).first()["load"] == 1
    assert rows(SF.loaded_rows(spark, target, "clinical").select("item", "value")) == [("s1", "40")]


def test_calls_by_the_dictionary_of_the_file(spark, tmp_path, small_splits):
    put(tmp_path, "one.txt", "#Calls: 0=AA, 1=AB, 2=NN", "probeset_id\tA.CEL\tB.CEL", *[f"SNP_A-{k}\t{k % 3}\t9" for k in range(40)])
    put(tmp_path, "two.txt", *[f"SNP_A-{k}\t{k % 2}\t0" for k in range(20)], "probeset_id\tC.CEL\tD.CEL", "#Calls: 0=BB,1=NN,0=CC")
    put(tmp_path, "three.txt", "SNP_A-1\t0")
    got = {(r["sample"], r["snp_id"]): r["alleles"] for r in SN.headed_calls(spark, str(tmp_path)).collect()}
    want = {**{("A", f"SNP_A-{k}"): [" A A", " A B", " 0 0"][k % 3] for k in range(40)}, **{("B", f"SNP_A-{k}"): None for k in range(40)}}
    want |= {**{("C", f"SNP_A-{k}"): [" C C", " 0 0"][k % 2] for k in range(20)}, **{("D", f"SNP_A-{k}"): " C C" for k in range(20)}, (None, "SNP_A-1"): None}
    assert got == want


def test_sections_of_split_files(spark, tmp_path, small_splits):
    line = lambda k: f"SNP_A-{k}\t{k % 22 + 1}\t{k * 10}\tx\ty\t{k / 4}"
    put(tmp_path, "S1.cn.txt", "[Header]", "SampleName=S1", "NumberDataRows=200", "not a row", "[Data]", *map(line, range(200)))
    put(tmp_path, "other.txt", "SampleName=S2", "NumberDataRows=7", "[Data]", *map(line, range(5)))
    put(tmp_path, "none.txt", "SampleName=S3", line(1))
    data, check = SN.copy_number_sections(spark, str(tmp_path))
    assert rows(check.drop("file_path")) == [("S1", 200, 200, True, True), ("S2", 7, 5, False, False), ("S3", None, 0, False, False)]
    assert rows(data.where("sample = 'S1'").select("snp_id", "chrom", "position", "copy_number")) == sorted((f"SNP_A-{k}", str(k % 22 + 1), str(k * 10), str(k / 4)) for k in range(200))


def test_registry_keeps_ids_and_positions(spark):
    schema = "trial string, subject_id string, sample string, patient_num long, platform string"
    first = spark.createDataFrame([("T", f"s{k}", None, k, "P1") for k in (5, 3, 9)] + [("T", "s3", "x", 3, "P2")], schema)
    none = spark.createDataFrame([], "dataset_id long, dataset_name string, patient_num long, platform string, trial string, position long")
    one = SN.register_datasets(none, first, ["patient_num"])
    known = spark.createDataFrame(one.collect(), none.schema)
    assert rows(known.select("platform", "position", "dataset_name")) == [("P1", 1, "T_s3"), ("P1", 2, "T_s5"), ("P1", 3, "T_s9"), ("P2", 1, "T_s3_x")]
    late = spark.createDataFrame([("T", "s1", " ", 1, "P1"), ("T", "s4", None, 4, "P1"), ("T", "s4", None, 4, "P1")], schema)
    added = SN.register_datasets(known, first.unionByName(late), ["patient_num"])
    assert rows(added.select("platform", "position", "dataset_name")) == [("P1", 4, "T_s1"), ("P1", 5, "T_s4")]
    assert sorted(r["dataset_id"] for r in known.unionByName(added).collect()) == [1, 2, 3, 4, 5, 6]


def test_parts_of_deliveries_replace_themselves_and_deliveries_their_study(spark, tmp_path):
    landing, history, name = tmp_path / "in", str(tmp_path / "out"), uuid.uuid4().hex

    def run(transform=None):
        folder_load.start(spark, str(landing), history, ["study_id", "v"], name=name, incremental=False, transform=transform).awaitTermination()
        return rows(TB.current(spark, history, "study_id", "delivery").select("study_id", "v"))

    put(landing / "2024-01", "a.txt", "study_id\tv", "S\t1", "S\t2", "R\t7")
    assert run() == [("R", "7"), ("S", "1"), ("S", "2")]
    put(landing / "2024-01", "b.txt", "study_id\tv", "S\t3")
    put(landing / "2024-01", "a~1.txt", "study_id\tv", "S\t10")
    put(landing / "2024-01", "a~2.txt", "study_id\tv", "S\t11")
    assert run() == [("R", "7"), ("S", "11"), ("S", "3")]
    put(landing / "2024-02", "a.txt", "study_id\tv", "S\t20")
    assert run() == [("R", "7"), ("S", "20")]
    put(landing / "2024-01", "c.txt", "study_id\tv", "S\t4")  # too late: its delivery is replaced
    assert run() == [("R", "7"), ("S", "20")] == run()
    assert TB.drop_superseded(spark, history, "study_id", "delivery") == 1
    assert rows(spark.read.parquet(history).select("study_id", "v")) == [("R", "7"), ("S", "20")]


def test_tied_rows_are_dealt_over_ranges(spark, monkeypatch):
    slices, write = [], numbering.staged

    def seen(df, name):
        out = write(df, name)
        if "__slice" in out.columns:
            slices.append({r["__slice"]: r["count"] for r in out.groupBy("__slice").count().collect()})
        return out

    monkeypatch.setattr(numbering, "staged", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("v"), F.lit("k").alias("k"))
    for keys in ([], ["k"]):
        got = number_rows(df.repartition(6), ["v"], keys).collect()
        assert sorted(r["row_num"] for r in got) == list(range(1, 20_001))
        order = [r["v"] for r in sorted(got, key=lambda r: r["row_num"])]
        assert order == sorted(order)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(len(s) > 3 and max(s.values()) < 10_000 for s in slices) and len(slices) == 2


def test_numbers_restart_per_key_with_and_without_slices(spark):
    df = spark.createDataFrame([(k, v) for k in ("a", "b", None) for v in (5, 3, None, 4, 1)], "k string, v int")
    want = rows(df.selectExpr("k", "v", "row_number() over (partition by k order by v) as row_num").select("k", "v", F.col("row_num").cast("long")))
    assert rows(number_rows(df, ["v"], ["k"])) == want
    assert rows(number_rows(df, ["v"], ["k"], slice_by=F.floor(F.col("v") / 2))) == want


def test_the_mapping_is_applied_inside_the_record(spark):
    columns = [f"c{k}" for k in range(1, 301)]
    raw = spark.range(4).select("id", *[F.concat(F.lit(f"{c}_"), F.col("id").cast("string")).alias(c) for c in columns])
    rules = [("", 1, "SUBJ_ID", None)] + [("Cat+X", k, f"L{k}", None) for k in range(2, 300)] + [("Cat+X", 300, "\\", "2A"), ("Cat+X", 2, "again", None)]
    got = ML.by_mapping(raw, spark.createDataFrame(rules, "category_cd string, column_number int, data_label string, label_source string"), "id", columns)
    assert got.count() == 4 * 300
    assert {r["data_label"] for r in got.where("column_number = 300").collect()} == {f"c2_{k}" for k in range(4)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "__values" not in generate and "Join" not in plan


def test_dates_by_the_formats_of_the_mapping(spark):
    raw = spark.createDataFrame([(1, "s1", "2024-03-01", "08:15", "05.02.2023"), (2, "s1", "2024-03-01 10:00", "08:15", "x"), (3, "s2", " ", "09:00", "06.02.2023"), (4, "s2", None, None, "05.02.2023"), (5, "s3", "31/12", None, None)],
                                "rec long, subj string, d string, tm string, enrol string")
    rules = spark.createDataFrame([("1", "SUBJ_ID", None, None), ("2", "VISIT_DATE", "yyyy-MM-dd", "3"), ("4", "ENROLL_DATE", "dd.MM.yyyy", None)], "column_number string, data_label string, date_format string, time_column string")
    got = ML.dates_by_mapping(raw, rules, "rec", "subj", ["subj", "d", "tm", "enrol"])
    text = F.date_format("date", "yyyy-MM-dd HH:mm")
    assert rows(got.where("data_label = 'VISIT_DATE'").select("rec", text, "status")) == [
        (1, "2024-03-01 08:15", "OK"), (2, "2024-03-01 10:00", "OK"), (3, None, "TIME_WITHOUT_DATE"), (4, None, "MISSING"), (5, None, "BAD_DATE")]
    enrol = ML.enrol_dates(got).withColumn("enrol_date", F.date_format("enrol_date", "yyyy-MM-dd"))
    assert rows(enrol) == [("s1", "2023-02-05", 1, 1), ("s2", "2023-02-05", 2, 0), ("s3", None, 0, 1)]


def test_columns_by_the_numbers_of_the_platform(spark):
    lines = spark.createDataFrame([("A", "# x"), ("A", "p1\tid\tg"), ("A", "p2"), ("B", "g2\tp3"), ("C", "p9")], "platform string, line string")
    places = spark.createDataFrame([("A", "probe", "1"), ("A", "gene", "3"), ("B", "probe", "2"), ("B", "gene", "1")], "platform string, field string, column_number string")
    assert rows(AN.by_number(lines, places, ["probe", "gene", "organism"])) == [("A", "p1", "g", None), ("A", "p2", None, None), ("B", "p3", "g2", None)]


def test_project_entities_resolve_in_order(spark):
    given = spark.createDataFrame([("p1", "T", "A1", "D1", "Aspirin; Nothing", "Flu"), ("p1", "T", "A1", "D2", "ASPIRIN", None), (None, "T", "A3", None, None, None), ("P2", None, None, "D9", None, "cold")],
                                  "accession string, title string, analysis string, dataset string, compounds string, diseases string")
    known = {
        "experiment": spark.createDataFrame([(4, "P2", "old")], "experiment_id long, accession string, title string"), "analysis": spark.createDataFrame([], "analysis_id long, experiment_id long, analysis string"),
        "dataset": spark.createDataFrame([], "dataset_id long, analysis_id long, dataset string"), "compound": spark.createDataFrame([(1, "aspirin")], "compound_id long, name string"),
        "disease": spark.createDataFrame([(1, "flu"), (2, "Cold")], "disease_id long, name string"),
    }
    out = AL.load_project(given, known)
    assert rows(out["experiment"]) == [(4, "P2", "old"), (5, "P1", "T")] and rows(out["analysis"]) == [(1, 5, "A1")]
    assert sorted(r["dataset"] for r in out["dataset"].collect()) == ["D1", "D2"] and {r["analysis_id"] for r in out["dataset"].collect()} == {1}
    assert rows(out["experiment_compound"]) == [(5, 1)] and rows(out["experiment_disease"]) == [(4, 2), (5, 1)]
    assert rows(out["rejects"]) == [("compound", "P1", "Nothing"), ("dataset", "P2", "D9"), ("experiment", None, "A3")]
    again = AL.load_project(given, {**known, **{k: out[k] for k in ("experiment", "analysis", "dataset")}})
    assert all(rows(again[k]) == rows(out[k]) for k in ("experiment", "analysis", "dataset"))


def test_occurrences_by_repeated_search(spark):
    def brute(text, piece, start, n):
        at = [i + 1 for i in range(len(text)) if text[i : i + len(piece)] == piece]
        hits = [i for i in at if i >= start] if start > 0 else [i for i in reversed(at) if i <= len(text) + start - len(piece) + 2]
        return hits[n - 1] if len(hits) >= n else 0

    texts = ["\\a\\b\\c\\", "aaaa", "", "x", "ab\\", "\\\\"]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    for piece in ("\\", "aa", "b"):
        for start in (1, 2, -1, -2):
            for n in (1, 2, 3):
                assert [r[0] for r in df.select(P.instr("s", piece, start, n)).collect()] == [brute(x, piece, start, n) for x in texts]


def test_platform_titles_and_kinds_decide_the_sample_nodes(spark):
    samples = spark.createDataFrame([("P1", "blood", None, None, "Bio+PLATFORM+TISSUETYPE"), ("P2", "blood", None, None, "Bio+PLATFORM"), ("P3", "skin", None, None, "Bio+PLATFORM")],
                                    "platform string, tissue_type string, attribute_1 string, attribute_2 string, category_cd string")
    platforms = spark.createDataFrame([("P1", "Chip", "GENE expression"), ("P2", "Other", "SNP"), ("P3", " ", "Gene Expression")], "platform string, title string, marker_type string")
    assert {r["node_path"] for r in A.sample_nodes(samples, "\\T\\", platforms).collect()} == {"\\T\\Bio\\Chip\\", "\\T\\Bio\\Chip\\blood\\"}


def test_mapping_reload_changes_and_adds(spark):
    schema = "subject_key string, sample_cd string, platform string, leaf_cd long, tissue_type string"
    known = spark.createDataFrame([("s1", "a", "P", 1, "old"), ("s2", "b", "P", 2, "same"), ("s3", "c", "P", 3, "gone")], schema)
    fresh = spark.createDataFrame([("s1", "a", "P", 7, None), ("s2", "b", "P", 2, "same"), ("s4", "d", "P", 4, "new")], schema)
    got = A.refresh_mapping(known, fresh).select("sample_cd", "leaf_cd", "tissue_type", "change")
    assert rows(got) == [("a", 7, None, "changed"), ("b", 2, "same", "identical"), ("c", 3, "gone", "kept"), ("d", 4, "new", "new")]


def test_metadata_upsert_types_and_cuts(spark):
    known = spark.createDataFrame([("A", None, 1.0, "old"), ("B", None, 2.0, "stays")], "study string, started date, n double, design string")
    landing = spark.createDataFrame([("A", "20240131", "x", " " + "d" * 30), ("C", "soon", "3", None), (" ", "20240131", "1", "no key")], "study string, started string, n string, design string")
    got = O.upsert_metadata(known, landing, "study", ["started"], ["n"], {"design": 20}).withColumn("started", F.col("started").cast("string"))
    assert rows(got) == [("A", "2024-01-31", None, "d" * 20), ("B", None, 2.0, "stays"), ("C", None, 3.0, None)]


def test_variant_catalogue_adds_each_thing_once(spark):
    lines = spark.createDataFrame([("1\t10\trs1;rs2\tA\tC\t.\tPASS\tGENEINFO=TP53:7157|X:9;VC=SNV",), ("2\t20\trs3\tG\tT\t.\tPASS\tVC=SNV",), ("1\t10\trs1\tA\tC\t.\tPASS\tGENEINFO=TP53:7157",)], "line string")
    schemas = {"info": "snp_info_id long, name string, chrom string, pos long", "gene_map": "snp_info_id long, name string, gene_id string",
               "keywords": "keyword_id long, keyword string, bio_data_id long, unique_id string, category string", "terms": "term string, keyword_id long, rank int, length int"}
    tables = {k: spark.createDataFrame([(4, "rs3", "2", 20)] if k == "info" else [], s) for k, s in schemas.items()}
    out = V.load_catalogue(V.variants(lines, []), **tables)
    assert rows(out["info"].select("name", "chrom", "pos")) == [("rs1", "1", 10), ("rs2", "1", 10)]
    assert rows(out["gene_map"].select("name", "gene_id")) == [("rs1", "7157"), ("rs1", "9"), ("rs2", "7157"), ("rs2", "9")]
    assert rows(out["keywords"].select("unique_id")) == [("SNP:rs1",), ("SNP:rs2",), ("SNP:rs3",)] and rows(out["terms"].select("term", "length")) == [("RS1", 3), ("RS2", 3), ("RS3", 3)]
    again = V.load_catalogue(V.variants(lines, []), **{k: tables[k].unionByName(out[k]) for k in schemas})
    assert all(df.count() == 0 for df in again.values())


def test_secured_studies_get_stubs_and_opened_ones_lose_their_object(spark):
    tree = spark.createDataFrame([("\\Top\\S1\\", 1, "S1", "S1"), ("\\Top\\S1\\x\\", 2, "x", "S1"), ("\\Top\\S2\\", 1, "S2", "S2"), ("\\Top\\S3\\", 1, "S3", "S3")], "path string, level int, name string, source string")
    studies = spark.createDataFrame([("S1", True), ("S2", False)], "source string, secured boolean")
    registered = spark.createDataFrame([("EXP:S2", "Top - S2", 1), ("EXP:S9", "other", 2)], "object_id string, display_name string, experiment_id long")
    experiments = spark.createDataFrame([(1, "S2", "t2"), (2, "S9", "t9")], "experiment_id long, accession string, title string")
    objects, after = TR.register_security(tree, studies, registered, experiments)
    assert rows(objects) == [("EXP:S1", "Top - S1", 3), ("EXP:S9", "other", 2)]
    assert rows(after) == [(1, "S2", "t2"), (2, "S9", "t9"), (3, "S1", "Metadata not available")]
