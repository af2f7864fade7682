import math
import statistics

import pytest
from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.operators import annotation as AN
from studyflow.operators import assay as A

TOP = "\\P\\T\\"


def inputs(spark):
    samples = spark.createDataFrame([("s1", 1, "G1"), ("s2", 2, "G1"), ("s3", 3, "G1"), ("s4", 4, "G2")], "sample_cd string, assay_id int, platform string")
    values = spark.createDataFrame([
        ("p", "s1", 2.0), ("p", "s1", 6.0), ("p", "s2", 16.0), ("p", "s3", 64.0), ("p", "s3", -5.0), ("q", "s1", 8.0), ("p", "s4", 9.0),
    ], "probeset string, sample_cd string, intensity double")
    probes = spark.createDataFrame([("G1", "p", 10), ("G1", "q", 11)], "platform string, probeset string, probeset_id int")
    return samples, values, probes


def test_raw_values(spark):
    out = {(r["probeset_id"], r["assay_id"]): r for r in A.process(*inputs(spark)).collect()}
    assert set(out) == {(10, 1), (10, 2), (10, 3), (11, 1)}  # platform G2 has no probes
    logs = [2.0, 4.0, 6.0]
    assert [out[(10, a)]["log_intensity"] for a in (1, 2, 3)] == pytest.approx(logs)  # replicates averaged, -5 ignored
    sd = statistics.stdev(logs)
    assert [out[(10, a)]["zscore"] for a in (1, 2, 3)] == pytest.approx([-2 / sd, 0, 2 / sd])
    assert out[(11, 1)]["zscore"] is None  # one sample has no spread


@pytest.mark.parametrize("kind, base, raw", [("L", 2, 4.0), ("L", -1, 0.0)])
def test_logged_values(spark, kind, base, raw):
    df = spark.createDataFrame([(2.0,)], "x double")
    got = A.log_transform(df, "x", kind, base).first()
    assert got["log_intensity"] == 2.0 and got["raw_intensity"] == raw


def test_transformed_values_are_only_clamped(spark):
    out = A.process(*inputs(spark), data_type="T").where("probeset_id = 10")
    assert {r["zscore"] for r in out.collect()} == {2.5} and out.where("assay_id = 1").first()["log_intensity"] == 4.0


def test_zscores_stay_in_range_and_centre(spark):
    df = spark.range(2000).select((F.col("id") % 5).alias("g"), F.pow(F.rand(3) * 10, 4).alias("log_intensity"))
    stats = A.zscore(df, ["g"]).groupBy("g").agg(F.max("zscore").alias("a"), F.min("zscore").alias("b"), F.median("zscore").alias("m")).collect()
    assert all(r["a"] <= 2.5 and r["b"] >= -2.5 and abs(r["m"]) < 1e-9 for r in stats)
    hot = A.zscore(df, ["g"])
    assert hot.join(A.zscore(df, ["g"]).withColumnRenamed("zscore", "z"), ["g", "log_intensity"]).where(F.abs(F.col("z") - F.col("zscore")) > 1e-9).count() == 0


SAMPLE = "site_id string, subject_id string, sample_cd string, platform string, title string, tissue_type string, attribute_1 string, attribute_2 string, category_cd string"


def samples(spark):
    return spark.createDataFrame([
        (None, "1", "a", "G1", "Chip", "Blood", "Day 1", None, "Bio_Data+PLATFORM+TISSUETYPE+ATTR1"), ("S", "2", "b", "G1", "Chip", "Liver", None, None, "Bio_Data+PLATFORM+TISSUETYPE+ATTR1"),
    ], SAMPLE)


def test_sample_nodes(spark):
    assert rows(A.sample_nodes(samples(spark), TOP).select("role", "node_path")) == sorted([
        ("LEAF", "\\P\\T\\Bio Data\\Chip\\Blood\\Day 1\\"), ("LEAF", "\\P\\T\\Bio Data\\Chip\\Liver\\"), ("PLATFORM", "\\P\\T\\Bio Data\\Chip\\"),
        ("TISSUETYPE", "\\P\\T\\Bio Data\\Chip\\Blood\\"), ("TISSUETYPE", "\\P\\T\\Bio Data\\Chip\\Liver\\"), ("ATTR1", "\\P\\T\\Bio Data\\Chip\\Blood\\Day 1\\"),
    ], key=repr)


def test_sample_mapping_finds_every_role(spark):
    paths = sorted({r["node_path"] for r in A.sample_nodes(samples(spark), TOP).collect()})
    concepts = spark.createDataFrame([(i + 1, p) for i, p in enumerate(paths)], "concept_cd long, concept_path string")
    code = {p: i + 1 for i, p in enumerate(paths)}
    patients = spark.createDataFrame([("T:1", 7), ("T:S:2", 8)], "subject_key string, patient_num long")
    out = {r["sample_cd"]: r for r in A.sample_mapping(samples(spark), patients, concepts, "T", TOP).collect()}
    leaf = code["\\P\\T\\Bio Data\\Chip\\Blood\\Day 1\\"]
    assert (out["a"]["leaf_cd"], out["a"]["attr1_cd"], out["a"]["attr2_cd"], out["a"]["data_uid"]) == (leaf, leaf, None, f"{leaf}-7")
    assert (out["b"]["platform_cd"], out["b"]["tissuetype_cd"], out["b"]["attr1_cd"]) == (code["\\P\\T\\Bio Data\\Chip\\"], code["\\P\\T\\Bio Data\\Chip\\Liver\\"], None)
    assert A.all_loaded(samples(spark), A.sample_mapping(samples(spark), patients, concepts, "T", TOP)).first()["complete"]


def test_incremental_scores_equal_a_full_load(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("g"), F.col("id").alias("s"), F.sqrt("id").alias("log_intensity"))
    part = A.zscore(df.where("s < 30"), ["g"])
    grown = A.append_samples(part, df, ["g", "s"], ["g"])
    assert rows(grown.select("g", "s", F.round("zscore", 9))) == rows(A.zscore(df, ["g"]).select("g", "s", F.round("zscore", 9)))


def test_annotation_by_header(spark):
    df = spark.createDataFrame([("p1", "TP53", "7157", ""), ("p2", "X", "---", "Mus musculus")], "`ID` string, `Gene Symbol` string, `ENTREZ_GENE_ID` string, `Species` string")
    columns = AN.header_columns(df.columns)
    assert rows(AN.by_header(df, "ID", columns, "G1")) == [("G1", "p1", "TP53", "7157", "Homo sapiens")]


def test_gene_assignments_and_controls(spark):
    df = spark.createDataFrame([("p1", "NM // A // title a // 1q // 5 /// NM // A // title a // 1q // 5"), ("p2", "---")], "probe string, assignment string")
    result, rejects = AN.gene_assignments(df, "assignment", ["probe"])
    assert rows(result) == [("p1", "A", "title a", "5")] and rows(rejects.select("probe")) == [("p2",)]


def test_platform_file(spark):
    def line(probe, rs, chrom, pos, genes):
        return ("\t".join([probe, rs, chrom, "", "", pos, *[""] * 6, genes, "", ""]),)

    gene = "NM // intron // 0 // x // TP53 // 7157 // tumor"
    lines = spark.createDataFrame([
        ("#comment",), line("ID", "rs", "chr", "pos", ""), line("AFFX-1", "rs9", "1", "5", "---"), line("S1", "rs1", "2", "7", f"{gene} /// a // b // c // d // B // --- // t"),
        line("S2", "---", "X", "8", gene), line("S3", "rs3", "", "9", "---"), ("S4\trs4",),
    ], "line string")
    probes, genes, mapped = AN.platform_probes(lines, AN.PLATFORM_LAYOUTS["GPL2005"])
    assert rows(probes) == [("S1", "rs1", "2", "7")] and rows(genes) == [("S1", "7157", "TP53"), ("S2", "7157", "TP53")]
    assert rows(mapped) == [("2", "S1", 0, "7"), ("X", "S2", 0, "8")]


def test_gap_fill_uses_the_smallest_id(spark):
    ann = spark.createDataFrame([("p", "A", None, "homo sapiens"), ("q", None, 7, "Homo sapiens"), ("r", None, None, "x")], "probe string, gene_symbol string, gene_id int, organism string")
    markers = spark.createDataFrame([("A", 9, "Homo sapiens"), ("A", 3, "Homo sapiens"), ("Z", 7, "Homo sapiens"), ("B", 7, "Homo sapiens")], "symbol string, gene_id int, organism string")
    assert rows(AN.fill_genes(ann, markers)) == [("p", "A", 3, "homo sapiens"), ("q", "B", 7, "Homo sapiens"), ("r", None, None, "x")]


def test_a_matrix_is_scored_from_one_reading(spark, tmp_path, monkeypatch):
    from studyflow.plans import assay_demo

    data = [(k % 4, k, 2000.0 + (k + 1) ** 2) for k in range(24)]
    spark.createDataFrame(data, "l_partkey long, l_suppkey long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, collapsed = spark.sparkContext.accumulator(0), assay_demo.collapsed

    def mark(x):
        seen.add(1)
        return x

    monkeypatch.setattr(assay_demo, "collapsed", lambda s, d: collapsed(s, d).withColumn("intensity", F.udf(mark, "double").asNondeterministic()("intensity")))
    for name in ("h10_zscore", "h45_incremental_matrix"):
        seen.value = 0
        out = {r["l_suppkey"]: r["log_intensity"] for r in getattr(assay_demo, name)(spark, str(tmp_path)).collect()}
        assert out == {k: round(2 * math.log2(k + 1), 4) for k in range(24)}
        assert seen.value == 24


def test_the_median_sorts_its_values_once(spark):
    from studyflow.operators.grouping import exact_median

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = exact_median(spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 3.0), (None, 5.0), (None, 6.0), ("c", None)], "k string, v double"), ["k"], "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = rows(out)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the running count lies under the join, in its order
    assert plan.index("SortMergeJoin") < plan.index("Window")
    assert sorted(got, key=str) == sorted([("a", 2.5), ("b", 3.0), (None, 5.5)], key=str)
