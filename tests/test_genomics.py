from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.operators import snp as SN
from studyflow.operators import vcf as V

CALL = "patient_id int, patient_pos int, snp_id string, snp_pos int, chrom string, allele_1 string, allele_2 string"


def calls(spark):
    data = [(p, p, f"s{s}", s, c, a, b) for p in (1, 2, 3) for s, c, a, b in ((1, "2", "A", "A"), (2, "2", "A", "B"), (1, "10", "0", "0"))]
    return spark.createDataFrame([(p, q, f"{s}c{c}", n, c, a, b) for p, q, s, n, c, a, b in data], CALL)


def test_probe_vectors_in_parts(spark):
    out = SN.by_probe(calls(spark), 2).where("snp_id = 's2c2'")
    assert rows(out) == [("s2c2", 1, 2, "AB AB"), ("s2c2", 2, 1, "AB")]


def test_patient_vectors_and_whole_genome(spark):
    parts = SN.by_patient(calls(spark), part_size=10)
    assert rows(parts.where("patient_id = 1")) == [(1, "10", 1, 1, "0 0"), (1, "2", 1, 2, "A A A B")]
    genome = SN.all_chromosomes(parts).where("patient_id = 1").orderBy("part").collect()
    assert [(r["chrom"], r["part"], r["vector"]) for r in genome] == [("ALL", 1, "A A A B"), ("ALL", 2, "0 0")]


def test_copy_numbers_leave_blanks(spark):
    cn = spark.createDataFrame([(1, "s1c2", 3)], "patient_id int, snp_id string, copy_number int")
    out = SN.by_patient(calls(spark), cn, 10).where("patient_id = 1 and chrom = '2'").first()
    assert out["vector"] == "3\tA\tA\n\tA\tB"


def test_matrix_calls_and_lgen(spark):
    m = spark.createDataFrame([("SNP_A-1", "0", "2")], "`probe` string, `G1.CEL` string, `G2.CEL` string")
    long = SN.matrix_calls(m, "probe", {"0": "AA", "2": "NN"})
    assert rows(long) == [("G1", "SNP_A-1", " A A"), ("G2", "SNP_A-1", " 0 0")]
    pairs = spark.createDataFrame([("G1", "P1")], "sample string, patient_id string")
    assert rows(SN.lgen(long, pairs)) == [("0", "P1", "SNP_A-1", " A A")]
    assert SN.calls_by_sample(long.withColumnRenamed("alleles", "call"), pairs).where("patient_id is null").count() == 1


def test_conflicts_and_section_check(spark):
    m = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], "sample string, patient_id int")
    assert rows(SN.conflicting_samples(m)) == [("a", 2)]
    declared = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1)], "sample string, declared int")
    assert {r["sample"]: (r["n_read"], r["complete"]) for r in SN.section_check(m, declared, ["sample"]).collect()} == {"a": (2, True), "b": (2, False), "c": (0, False)}


VCF = [
    "##fileformat=VCFv4.1", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO", "1\t100\trs1;rs2\tA\tT\t.\tPASS\tRS=1;GENEINFO=TP53:7157|WRAP53:55135;VC=SNV", "X\t7\trs3\tG\tC\t.\t.\tVC=DIV",
]


def test_variants_and_genes(spark):
    lines = spark.createDataFrame([(v,) for v in VCF], "line string")
    out = V.variants(lines, ["RS", "AF"])
    assert rows(out.select("chrom", "pos", "rs_id", "variant_class", "rs", "af")) == [("1", 100, "rs1", "SNV", "1", ""), ("1", 100, "rs2", "SNV", "1", ""), ("X", 7, "rs3", "DIV", "", "")]
    assert rows(V.genes(out).select("rs_id", "gene_symbol", "gene_id")) == [("rs1", "TP53", "7157"), ("rs1", "WRAP53", "55135"), ("rs2", "TP53", "7157"), ("rs2", "WRAP53", "55135")]
    known = spark.createDataFrame([("rs1",)], "rs_id string")
    assert rows(V.catalogue(out, known).select("rs_id")) == [("rs2",), ("rs3",)]


def test_a_variant_file_is_read_once(spark, tmp_path, monkeypatch):
    from studyflow.plans import snp_demo

    data = [(k, 1 + k % 3, k % 4, k % 5, "N" if k % 2 else "R", "O", 1.0) for k in range(30)]
    spark.createDataFrame(data, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, lines = spark.sparkContext.accumulator(0), snp_demo.vcf_lines

    def mark(line):
        seen.add(1)
        return line

    monkeypatch.setattr(snp_demo, "vcf_lines", lambda s, d: lines(s, d).withColumn("line", F.udf(mark, "string").asNondeterministic()("line")))
    out = snp_demo.h31_catalogue_load(spark, str(tmp_path))
    added = {r["added"]: r["count"] for r in out.groupBy("added").count().collect()}
    assert seen.value == 30
    # ids 0 and 3 stand for two variants each; the known ones are those that end in 0
    assert added["keywords"] == added["terms"] == 45 and added["info"] < 45
