"""Queries of genotype, copy-number and variant operators: customers as patients, parts as SNPs."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.functions import genome as GN
from studyflow.operators import snp as SN
from studyflow.operators import vcf as V
from studyflow.operators.numbering import surrogate_ids
from studyflow.plans.data import t
from studyflow.plans.registry import query
from studyflow.session import staged, work_path

# One call per (patient, SNP): alleles from the flags of the last such order line.
CALLS_SQL = """
calls AS (
  SELECT l_suppkey AS patient_id, l_partkey AS snp_id, CAST(l_partkey % 25 + 1 AS VARCHAR) AS chrom, max(l_returnflag) AS allele_1, max(l_linestatus) AS allele_2
  FROM lineitem GROUP BY ALL),
patients AS (SELECT s_suppkey AS patient_id, row_number() OVER (ORDER BY s_name) AS patient_pos FROM supplier),
snps AS (SELECT p_partkey AS snp_id, row_number() OVER (PARTITION BY p_partkey % 25 ORDER BY p_partkey) AS snp_pos FROM part),
placed AS (SELECT c.*, patient_pos, snp_pos FROM calls c JOIN patients USING (patient_id) JOIN snps USING (snp_id)),
cn AS (SELECT l_suppkey AS patient_id, l_partkey AS snp_id, max(l_linenumber) AS copy_number FROM lineitem WHERE l_linenumber > 2 GROUP BY ALL)"""


def placed_calls(spark, sf):
    lines = t(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus")
    calls = lines.groupBy(F.col("l_suppkey").alias("patient_id"), F.col("l_partkey").alias("snp_id")).agg(
        F.max("l_returnflag").alias("allele_1"), F.max("l_linestatus").alias("allele_2")
    ).withColumn("chrom", (F.col("snp_id") % 25 + 1).cast("string"))
    supplier = t(spark, sf, "supplier", F.col("s_suppkey").alias("patient_id"), "s_name")
    part = t(spark, sf, "part", F.col("p_partkey").alias("snp_id")).withColumn("c", F.col("snp_id") % 25)
    patients = SN.ordered_definition(supplier, ["s_name"], slice_by=F.substring("s_name", 1, 14), out="patient_pos").drop("s_name")
    snps = SN.ordered_definition(part, ["snp_id"], ["c"], F.floor(F.col("snp_id") / 1000000), "snp_pos").drop("c")
    return calls.join(patients, "patient_id").join(snps, "snp_id")


def copy_numbers(spark, sf):
    return t(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_linenumber").where("l_linenumber > 2").groupBy(
        F.col("l_suppkey").alias("patient_id"), F.col("l_partkey").alias("snp_id")
    ).agg(F.max("l_linenumber").alias("copy_number"))


@query(f"""WITH {CALLS_SQL} SELECT snp_id, (patient_pos - 1) // 40 + 1 AS part, count(*) AS n_calls, string_agg(allele_1 || allele_2, ' ' ORDER BY patient_pos) AS vector FROM placed GROUP BY ALL""")
def g08_genotypes_by_probe(spark, sf):
    return SN.by_probe(placed_calls(spark, sf), 40)


@query(f"""WITH {CALLS_SQL} SELECT patient_id, chrom, (snp_pos - 1) // 50 + 1 AS part, count(*) AS n_calls, string_agg(allele_1 || ' ' || allele_2, ' ' ORDER BY snp_pos) AS vector FROM placed GROUP BY ALL""")
def g09_genotypes_by_patient(spark, sf):
    return SN.by_patient(placed_calls(spark, sf), part_size=50)


@query(f"""WITH {CALLS_SQL}, parts AS (SELECT patient_id, chrom, (snp_pos - 1) // 50 + 1 AS p, count(*) AS n_calls, string_agg(allele_1 || ' ' || allele_2, ' ' ORDER BY snp_pos) AS vector FROM placed WHERE CAST(chrom AS INTEGER) <= 24 GROUP BY ALL)
SELECT patient_id, 'ALL' AS chrom, row_number() OVER (PARTITION BY patient_id ORDER BY CAST(chrom AS INTEGER), p) AS part, n_calls, vector FROM parts""")
def g09_whole_genome(spark, sf):
    return SN.all_chromosomes(SN.by_patient(placed_calls(spark, sf), part_size=50))


@query("""SELECT p_partkey AS snp_id, CAST(p_size AS VARCHAR) AS chrom, p_partkey * 10 AS position FROM part WHERE p_partkey % 3 <> 0""")
def h22_new_snps(spark, sf):
    part = t(spark, sf, "part", F.col("p_partkey").alias("snp_id"), F.col("p_size").cast("string").alias("chrom")).withColumn("position", F.col("snp_id") * 10)
    return SN.new_snps(part, part.where("snp_id % 3 = 0"))


@query("""WITH g AS (SELECT p_name AS symbol, min(p_size) AS gene_id FROM part WHERE p_size % 2 = 0 GROUP BY 1)
SELECT p_partkey AS snp_id, p_name AS symbol, gene_id, 'loaded' AS outcome FROM part LEFT JOIN g ON p_name = symbol WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, p_name, NULL, 'reject' FROM part WHERE p_partkey % 3 <> 0""")
def h22_snp_gene_links(spark, sf):
    part = t(spark, sf, "part", F.col("p_partkey").alias("snp_id"), F.col("p_name").alias("symbol"), "p_size")
    genes = part.where("p_size % 2 = 0").select(F.upper("symbol").alias("symbol"), F.col("p_size").alias("gene_id"))
    links, rejects = SN.gene_links(part.select("snp_id", "symbol"), part.where("snp_id % 3 = 0"), genes)
    return links.withColumn("outcome", F.lit("loaded")).unionByName(
        rejects.select("snp_id", "symbol", F.lit(None).cast("int").alias("gene_id"), F.lit("reject").alias("outcome"))
    )


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '23' WHEN 1 THEN '24' WHEN 2 THEN '25' WHEN 3 THEN '26' ELSE CAST(p_size AS VARCHAR) END AS chrom FROM part""")
def h23_chromosome_codes(spark, sf):
    size = F.col("p_size")
    chrom = F.when(size % 6 == 0, "X").when(size % 6 == 1, "Y").when(size % 6 == 2, "XY").when(size % 6 == 3, "MT").otherwise(size.cast("string"))
    return t(spark, sf, "part", "p_partkey", "p_size").select("p_partkey", GN.chromosome_code(chrom).alias("chrom"))


def genotype_matrix(spark, sf):
    lines = t(spark, sf, "lineitem", "l_partkey", "l_linenumber", "l_returnflag")
    samples = [f"GSM{i}.CEL" for i in range(1, 8)]
    cells = [F.max(F.when(F.col("l_linenumber") == i, F.col("l_returnflag"))).alias(s) for i, s in enumerate(samples, 1)]
    return lines.groupBy("l_partkey").agg(*cells), samples


CALL_CODES = {"A": "AA", "N": "NN", "R": "AB"}

MATRIX_SQL = """m AS (SELECT l_partkey AS snp_id, 'GSM' || l_linenumber AS sample, l_linenumber AS n, max(l_returnflag) AS code FROM lineitem GROUP BY ALL),
called AS (SELECT sample, snp_id, n, CASE code WHEN 'A' THEN ' A A' WHEN 'N' THEN ' 0 0' ELSE ' A B' END AS alleles FROM m)"""


@query(f"WITH {MATRIX_SQL} SELECT sample, snp_id, alleles FROM called")
def h24_matrix_calls(spark, sf):
    matrix, samples = genotype_matrix(spark, sf)
    return SN.matrix_calls(matrix.withColumnRenamed("l_partkey", "snp_id"), "snp_id", CALL_CODES, samples)


def write_files(rows, path):
    """One text file for each ``file``, lines in the order of ``place``."""
    rows.repartition("file").sortWithinPartitions("file", "place").select("file", "line").write.partitionBy("file").text(path)


@query(r"""WITH m AS (SELECT l_partkey AS p, l_linenumber AS n, max(l_returnflag) AS code FROM lineitem GROUP BY ALL),
grid AS (SELECT p, n, coalesce(code, '') AS code FROM (SELECT DISTINCT p FROM m) CROSS JOIN (SELECT unnest(generate_series(1, 7)) AS n) LEFT JOIN m USING (p, n))
SELECT 'GSM' || (n + p % 2 * 10) AS sample, 'SNP_A-' || p AS snp_id, code, CASE WHEN p % 2 = 0 THEN CASE code WHEN 'A' THEN ' A A' WHEN 'N' THEN ' 0 0' WHEN 'R' THEN ' A B' END
  ELSE CASE code WHEN 'A' THEN ' B B' WHEN 'N' THEN ' A B' END END AS alleles FROM grid""")
def h24_headed_files(spark, sf):
    """Two files, each with a dictionary and sample names of its own, in one scan."""
    matrix, samples = genotype_matrix(spark, sf)
    file = (F.col("l_partkey") % 2).cast("int").alias("file")
    data = matrix.select(file, F.col("l_partkey").alias("place"), F.concat_ws("\t", F.concat(F.lit("SNP_A-"), F.col("l_partkey").cast("string")), *[F.coalesce(s, F.lit("")) for s in [F.col(f"`{x}`") for x in samples]]).alias("line"))
    heads = [(f, -3 + k, line) for f, calls in ((0, "A=AA, N=NN, R=AB"), (1, "A=BB,N=AB")) for k, line in enumerate((
        "# a comment", "#Calls: " + calls, "\t".join(["probeset_id", *(f"GSM{i + f * 10}.CEL" for i in range(1, 8))])))]
    path = work_path(spark, "genotypes")
    write_files(data.unionByName(spark.createDataFrame(heads, "file int, place long, line string")), path)
    return SN.headed_calls(spark, path).drop("file_path")


@query(f"WITH {MATRIX_SQL} SELECT '0' AS family, 'P' || n AS patient_id, snp_id, alleles FROM called WHERE n <= 5")
def h25_lgen(spark, sf):
    pairs = spark.createDataFrame([(f"GSM{i}", f"P{i}") for i in range(1, 6)], "sample string, patient_id string")
    return SN.lgen(h24_matrix_calls(spark, sf), pairs)


@query("""SELECT '0' AS family, c_custkey AS patient_id, '0' AS father, '0' AS mother, CASE c_nationkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '0' END AS sex, '-9' AS phenotype FROM customer""")
def h25_fam(spark, sf):
    sex = F.when(F.col("c_nationkey") % 3 == 0, "Male").when(F.col("c_nationkey") % 3 == 1, "Female").otherwise("Unknown")
    return SN.fam(t(spark, sf, "customer", F.col("c_custkey").alias("patient_id"), sex.alias("sex")))


@query("""SELECT CASE WHEN p_size % 6 = 0 THEN '23' ELSE CAST(p_size AS VARCHAR) END AS chrom, p_partkey AS snp_id, 0 AS distance, p_partkey * 10 AS position FROM part""")
def h25_map(spark, sf):
    chrom = F.when(F.col("p_size") % 6 == 0, "X").otherwise(F.col("p_size").cast("string"))
    return SN.map_rows(t(spark, sf, "part", F.col("p_partkey").alias("snp_id"), chrom.alias("chrom"), (F.col("p_partkey") * 10).alias("position")))


@query("""SELECT s_suppkey, n + CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS declared, n AS n_read, s_suppkey % 10 <> 0 AS complete FROM (
  SELECT s_suppkey, count(l_suppkey) AS n FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1)""")
def h26_declared_rows(spark, sf):
    rows = t(spark, sf, "lineitem", F.col("l_suppkey").alias("s_suppkey"))
    n = t(spark, sf, "supplier", "s_suppkey").join(rows.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n")), "s_suppkey", "left")
    declared = n.select("s_suppkey", (F.coalesce("n", F.lit(0)) + F.when(F.col("s_suppkey") % 10 == 0, 1).otherwise(0)).alias("declared"))
    return SN.section_check(rows, declared, ["s_suppkey"])


def copy_number_files(spark, sf):
    """A vendor file of every line number; each third one declares a row too many."""
    lines = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    text = lambda c: F.col(c).cast("string")
    data = lines.select("l_linenumber", F.col("l_orderkey").alias("place"), F.concat_ws("\t", F.concat(F.lit("SNP_A-"), text("l_orderkey")), text("l_linenumber"), text("l_partkey"), F.lit("x"), F.lit("y"), text("l_suppkey")).alias("line"))
    counts = lines.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    declared = (F.col("n") + F.when(F.col("l_linenumber") % 3 == 0, 1).otherwise(0)).cast("string")
    heads = counts.select("l_linenumber", F.posexplode(F.array(F.lit("[Header]"), F.concat(F.lit("SampleName=S"), text("l_linenumber")), F.concat(F.lit("NumberDataRows="), declared), F.lit("[Data]"))).alias("place", "line"))
    path = work_path(spark, "copy-numbers")
    write_files(data.unionByName(heads.withColumn("place", F.col("place").cast("long") - 4)).withColumn("file", F.col("l_linenumber").cast("int")).drop("l_linenumber"), path)
    return SN.copy_number_sections(spark, path)


@query("""SELECT 'S' || l_linenumber AS sample, 'SNP_A-' || l_orderkey AS snp_id, CAST(l_linenumber AS VARCHAR) AS chrom, CAST(l_partkey AS VARCHAR) AS position, CAST(l_suppkey AS VARCHAR) AS copy_number FROM lineitem""")
def h26_data_sections(spark, sf):
    return copy_number_files(spark, sf)[0].drop("file_path")


@query("""SELECT 'S' || l_linenumber AS sample, count(*) + CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END AS declared, count(*) AS n_read, l_linenumber % 3 <> 0 AS complete FROM lineitem GROUP BY l_linenumber""")
def h26_section_report(spark, sf):
    return copy_number_files(spark, sf)[1].drop("file_path", "name_fits")


@query("SELECT 'chrom=' || (l_partkey % 25 + 1) AS folder, count(*) AS n_rows FROM lineitem GROUP BY 1")
def h26_files_by_chromosome(spark, sf):
    from studyflow.sources.files import read_lines

    path = work_path(spark, "copy-number")
    rows = t(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_linenumber", (F.col("l_partkey") % 25 + 1).alias("chrom"))
    SN.write_by_chromosome(rows, path)
    return read_lines(spark, path + "/*/*.csv").groupBy(F.element_at(F.split("file_path", "/"), -2).alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH {CALLS_SQL} SELECT patient_id, chrom, (snp_pos - 1) // 50 + 1 AS part, count(*) AS n_calls,
  string_agg(coalesce(CAST(copy_number AS VARCHAR), '') || chr(9) || allele_1 || chr(9) || allele_2, chr(10) ORDER BY snp_pos) AS vector
FROM placed LEFT JOIN cn USING (patient_id, snp_id) GROUP BY ALL""")
def h27_genotypes_with_copy_number(spark, sf):
    return SN.by_patient(placed_calls(spark, sf), copy_numbers(spark, sf), 50)


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position FROM orders")
def h28_ordered_definition(spark, sf):
    rows = t(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    return SN.ordered_definition(rows, ["o_orderdate", "o_orderkey"], ["o_custkey"], F.to_date("o_orderdate")).drop("o_orderdate")


@query("""WITH s AS (SELECT c_custkey, 'T1_' || c_custkey || CASE WHEN c_nationkey % 2 = 0 THEN '_' || c_mktsegment ELSE '' END AS dataset_name, 'GPL' || c_nationkey % 3 AS platform, CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END AS load FROM customer)
SELECT load, dataset_name, c_custkey AS patient_num, platform, row_number() OVER (PARTITION BY platform ORDER BY load, c_custkey) AS position,
  row_number() OVER (ORDER BY load, substr(md5(dataset_name || chr(1) || c_custkey), 1, 3), dataset_name, c_custkey) AS dataset_id FROM s""")
def h28_dataset_registry(spark, sf):
    """Three quarters of the subjects, then all of them: the late ones follow, the others keep id and position."""
    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    subjects = customer.select(
        F.lit("T1").alias("trial"), F.col("c_custkey").cast("string").alias("subject_id"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias("sample"), F.col("c_custkey").alias("patient_num"),
        F.concat(F.lit("GPL"), (F.col("c_nationkey") % 3).cast("string")).alias("platform"),
    )
    path = work_path(spark, "registry")
    none = spark.createDataFrame([], "dataset_id long, dataset_name string, patient_num long, platform string, trial string, position long")
    for load, (known, rows) in enumerate(((lambda: none, subjects.where("patient_num % 4 <> 0")), (lambda: spark.read.parquet(path), subjects)), 1):
        SN.register_datasets(known(), rows, ["patient_num"]).withColumn("load", F.lit(load)).write.mode("append").parquet(path)
    return spark.read.parquet(path).drop("trial")


@query("SELECT l_partkey AS sample, count(DISTINCT l_suppkey) AS n_patients FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def h29_conflicting_samples(spark, sf):
    return SN.conflicting_samples(t(spark, sf, "lineitem", F.col("l_partkey").alias("sample"), F.col("l_suppkey").alias("patient_id")))


def vcf_lines(spark, sf):
    # Groups are hardly larger than a row: combined (here, sorted) after the shuffle only.
    lines = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice").repartition("l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s"), F.max("l_returnflag").alias("r"), F.max("l_linestatus").alias("a")
    )
    ids = F.when(F.col("p") % 3 == 0, F.concat(F.lit("rs"), F.col("p").cast("string"), F.lit(";rs9"), F.col("p").cast("string"))).otherwise(F.concat(F.lit("rs"), F.col("p").cast("string")))
    gene = F.concat(F.lit("G"), F.col("s").cast("string"), F.lit(":"), F.col("s").cast("string"))
    genes = F.when(F.col("s") % 2 == 0, F.concat(gene, F.lit("|GX:7"))).otherwise(gene)
    info = F.concat_ws(";", F.concat(F.lit("RS="), F.col("p").cast("string")), F.when(F.col("s") % 5 != 0, F.concat(F.lit("GENEINFO="), genes)), F.concat(F.lit("VC="), F.when(F.col("r") == "N", "SNV").otherwise("DIV")), F.lit("dbSNPBuildID=132"))
    return lines.select(F.concat_ws("\t", (F.col("l_linenumber")).cast("string"), F.col("l_orderkey").cast("string"), ids, "r", "a", F.lit("."), F.lit("PASS"), info).alias("line"))


VCF_SQL = """
v AS (SELECT l_orderkey AS pos, l_linenumber AS chrom, max(l_partkey) AS p, max(l_suppkey) AS s, max(l_returnflag) AS r, max(l_linestatus) AS a FROM lineitem GROUP BY ALL),
vars AS (SELECT CAST(chrom AS VARCHAR) AS chrom, pos, unnest(CASE WHEN p % 3 = 0 THEN ['rs' || p, 'rs9' || p] ELSE ['rs' || p] END) AS rs_id, r AS ref, a AS alt,
  CASE WHEN r = 'N' THEN 'SNV' ELSE 'DIV' END AS variant_class, CASE WHEN s % 5 = 0 THEN '' WHEN s % 2 = 0 THEN 'G' || s || ':' || s || '|GX:7' ELSE 'G' || s || ':' || s END AS gene_info,
  CAST(p AS VARCHAR) AS rs, '132' AS dbsnpbuildid, s FROM v)"""


@query(f"WITH {VCF_SQL} SELECT * EXCLUDE (s) FROM vars")
def h30_variants(spark, sf):
    return V.variants(vcf_lines(spark, sf), ["RS", "dbSNPBuildID"])


@query(f"""WITH {VCF_SQL} SELECT DISTINCT chrom, pos, rs_id, 'G' || s AS gene_symbol, CAST(s AS VARCHAR) AS gene_id FROM vars WHERE s % 5 <> 0
UNION SELECT chrom, pos, rs_id, 'GX', '7' FROM vars WHERE s % 5 <> 0 AND s % 2 = 0""")
def h30_variant_genes(spark, sf):
    return V.genes(V.variants(vcf_lines(spark, sf), []))


@query(f"""WITH {VCF_SQL}, firsts AS (SELECT rs_id, min((chrom, pos, ref, alt)) AS k FROM vars WHERE rs_id NOT LIKE '%0' GROUP BY 1)
SELECT rs_id, min(chrom) AS chrom, min(pos) AS pos, min(ref) AS ref, min(alt) AS alt, min(variant_class) AS variant_class
FROM vars JOIN firsts USING (rs_id) WHERE (chrom, pos, ref, alt) = k GROUP BY 1""")
def h31_variant_catalogue(spark, sf):
    rows = V.variants(vcf_lines(spark, sf), [])
    return V.catalogue(rows, rows.where("rs_id like '%0'").select("rs_id").distinct())


@query(f"""WITH {VCF_SQL}, places AS (SELECT DISTINCT rs_id, chrom, pos FROM vars),
pairs AS (SELECT DISTINCT rs_id, CAST(s AS VARCHAR) AS gene_id FROM vars WHERE s % 5 <> 0 UNION SELECT rs_id, '7' FROM vars WHERE s % 5 <> 0 AND s % 2 = 0)
SELECT 'info' AS added, rs_id AS name, chrom AS value FROM places WHERE rs_id NOT LIKE '%0' UNION ALL SELECT 'gene_map', rs_id, gene_id FROM places JOIN pairs USING (rs_id)
UNION ALL SELECT 'keywords', 'SNP:' || rs_id, 'SNP' FROM places UNION ALL SELECT 'terms', upper(rs_id), CAST(length(rs_id) AS VARCHAR) FROM places""")
def h31_catalogue_load(spark, sf):
    """Variants, gene map, keywords and terms that a file adds to a catalogue which knows every tenth id or so."""
    rows = staged(V.variants(vcf_lines(spark, sf), []).select("rs_id", "chrom", "pos", "gene_info"), "variants")
    known = rows.where("rs_id like '%0'").select(F.col("rs_id").alias("name"), "chrom", "pos").distinct()
    tables = {
        "gene_map": "snp_info_id long, name string, gene_id string", "keywords": "keyword_id long, keyword string, bio_data_id long, unique_id string, category string",
        "terms": "term string, keyword_id long, rank int, length int",
    }
    info = staged(surrogate_ids(known, ["name", "chrom", "pos"], "snp_info_id").select("snp_info_id", "name", "chrom", "pos"), "snp-info")
    out = V.load_catalogue(rows, info, **{k: spark.createDataFrame([], s) for k, s in tables.items()})
    cell = lambda table, name, value: out[table].select(F.lit(table).alias("added"), F.col(name).alias("name"), F.col(value).cast("string").alias("value"))
    return cell("info", "name", "chrom").unionByName(cell("gene_map", "name", "gene_id")).unionByName(cell("keywords", "unique_id", "category")).unionByName(cell("terms", "term", "length"))


@query(f"WITH {MATRIX_SQL} SELECT sample, CASE WHEN n <= 5 THEN 'P' || n END AS patient_id, snp_id, alleles AS call FROM called")
def h46_calls_by_sample(spark, sf):
    pairs = spark.createDataFrame([(f"GSM{i}", f"P{i}") for i in range(1, 6)], "sample string, patient_id string")
    return SN.calls_by_sample(h24_matrix_calls(spark, sf).withColumnRenamed("alleles", "call"), pairs)
