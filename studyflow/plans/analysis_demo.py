"""Queries of differential-analysis operators: suppliers as analyses, parts as probes, order lines as results."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.operators import analysis as AL
from studyflow.operators import assay as A
from studyflow.plans.data import money, t
from studyflow.plans.registry import query
from studyflow.plans.rows_demo import ERF_SQL
from studyflow.sources.tables import spread

# --- import and validation -------------------------------------------------------

RAW_SQL = """
raw AS (
  SELECT 'sup' || l_suppkey AS analysis_id, 'P' || l_partkey AS probeset,
    CASE WHEN l_linenumber = 7 THEN '.' ELSE printf('%.2f', l_discount) END AS preferred_pvalue, CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE printf('%.2f', l_tax) END AS raw_pvalue,
    CASE WHEN l_returnflag = 'A' THEN '' ELSE printf('%.2f', l_tax) END AS adjusted_pvalue, CASE WHEN l_quantity > 45 THEN 'high' ELSE printf('%.2f', l_quantity - 25) END AS fold_change,
    printf('%.2f', l_quantity) AS lsmean_1, CASE WHEN l_linestatus = 'F' THEN '.' ELSE printf('%.2f', l_extendedprice) END AS lsmean_2 FROM lineitem),
valid AS (
  SELECT analysis_id, probeset, try_cast(preferred_pvalue AS DOUBLE) AS preferred_pvalue, try_cast(raw_pvalue AS DOUBLE) AS raw_pvalue, try_cast(adjusted_pvalue AS DOUBLE) AS adjusted_pvalue,
    try_cast(fold_change AS DOUBLE) AS fold_change,
    CASE WHEN try_cast(lsmean_2 AS DOUBLE) IS NOT NULL THEN least(CAST(lsmean_1 AS DOUBLE), try_cast(lsmean_2 AS DOUBLE)) END AS min_lsmean,
    CASE WHEN try_cast(lsmean_2 AS DOUBLE) IS NOT NULL THEN greatest(CAST(lsmean_1 AS DOUBLE), try_cast(lsmean_2 AS DOUBLE)) END AS max_lsmean
  FROM raw WHERE try_cast(preferred_pvalue AS DOUBLE) IS NOT NULL AND try_cast(fold_change AS DOUBLE) IS NOT NULL)"""


def raw_results(spark, sf):
    line = t(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    n = F.col("l_linenumber")
    return line.select(
        F.concat(F.lit("sup"), F.col("l_suppkey").cast("string")).alias("analysis_id"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("probeset"),
        F.when(n == 7, ".").otherwise(money(F.col("l_discount"))).alias("preferred_pvalue"), F.when(n == 6, "n/a").otherwise(money(F.col("l_tax"))).alias("raw_pvalue"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(money(F.col("l_tax"))).alias("adjusted_pvalue"),
        F.when(F.col("l_quantity") > 45, "high").otherwise(money(F.col("l_quantity") - 25)).alias("fold_change"), money(F.col("l_quantity")).alias("lsmean_1"),
        F.when(F.col("l_linestatus") == "F", ".").otherwise(money(F.col("l_extendedprice"))).alias("lsmean_2"),
    )


@query("""SELECT upper(s_name) AS study_id, CASE WHEN s_suppkey % 3 <> 0 THEN 'nation ' || s_nationkey END AS title, CASE WHEN s_suppkey % 2 = 0 THEN printf('%.2f', s_acctbal) END AS cutoff
FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0""")
def h32_import_external(spark, sf):
    rows = t(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal").select(
        F.concat(F.lit('"'), F.lower("s_name"), F.lit('"')).alias("study_id"),
        F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit('"nation '), F.col("s_nationkey").cast("string"), F.lit('"'))).otherwise('""').alias("title"),
        F.when(F.col("s_suppkey") % 2 == 0, money(F.col("s_acctbal"))).alias("cutoff"),
    )
    return AL.import_external(rows)


@query(f"WITH {RAW_SQL} SELECT * FROM valid")
def h33_validate_results(spark, sf):
    return AL.validate_results(raw_results(spark, sf))


@query(f"WITH {RAW_SQL} SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM valid) AS n_dropped, (SELECT count(*) FROM raw) AS n_read")
def h33_dropped_results(spark, sf):
    return AL.dropped_results(raw_results(spark, sf))


@query(f"WITH {RAW_SQL} SELECT 'A' || s_nationkey AS study_id, v.* FROM valid v JOIN supplier ON analysis_id = 'sup' || s_suppkey WHERE s_suppkey % 3 <> 0")
def h33_load_results(spark, sf):
    supplier = t(spark, sf, "supplier", "s_suppkey", "s_nationkey").where("s_suppkey % 3 <> 0")
    analyses = supplier.select(F.concat(F.lit(" SUP"), F.col("s_suppkey").cast("string")).alias("analysis_cd"), F.concat(F.lit("A"), F.col("s_nationkey").cast("string")).alias("study_id"))
    return AL.load(raw_results(spark, sf), analyses)


# --- normalised p-values ---------------------------------------------------------

RESULTS_SQL = """
res AS (SELECT l_suppkey AS analysis_id, l_partkey AS probeset, l_orderkey, l_linenumber, l_quantity - 25 AS fold_change, CASE WHEN l_linenumber <> 3 THEN l_discount END AS pvalue,
  l_tax * 100 AS min_lsmean, l_quantity AS max_lsmean FROM lineitem)"""


def results(spark, sf):
    return t(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax").select(
        F.col("l_suppkey").alias("analysis_id"), F.col("l_partkey").alias("probeset"), "l_orderkey", "l_linenumber", (F.col("l_quantity") - 25).alias("fold_change"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("pvalue"), (F.col("l_tax") * 100).alias("min_lsmean"), F.col("l_quantity").alias("max_lsmean"),
    )


def _npv_sql(source, mu, sd, value="fold_change"):
    """SQL of the normalised p-value from columns of ``source`` (adds ``npv``)."""
    return f"""
zed AS (SELECT *, (abs({value}) - {mu}) / {sd} / sqrt(2) AS x FROM {source}),
tee AS (SELECT *, 1 / (1 + 0.5 * abs(x)) AS t FROM zed),
scored AS (SELECT *, CASE WHEN x IS NOT NULL THEN greatest(1 - 0.5 * (1 + CASE WHEN x > 0 THEN {ERF_SQL} ELSE -{ERF_SQL} END), 1e-5) END AS npv FROM tee)"""


NPV_SQL = RESULTS_SQL + """,
st AS (SELECT analysis_id, avg(fold_change) AS mu, stddev_samp(fold_change) AS sd FROM res GROUP BY 1),
joined AS (SELECT res.*, mu, sd FROM res JOIN st USING (analysis_id)),""" + _npv_sql("joined", "mu", "nullif(sd, 0)")


@query(f"WITH {NPV_SQL} SELECT analysis_id, probeset, l_orderkey, l_linenumber, fold_change, round(npv, 6) AS npv FROM scored")
def h34_normalised_pvalue(spark, sf):
    out = AL.add_npv(results(spark, sf), ["analysis_id"])
    return out.select("analysis_id", "probeset", "l_orderkey", "l_linenumber", "fold_change", F.round("npv", 6).alias("npv"))


@query(f"""WITH {RESULTS_SQL}, st AS (SELECT analysis_id, round(avg(fold_change), 4) AS mu, round(stddev_samp(fold_change), 4) AS sd, count(*) AS data_ct FROM res WHERE fold_change IS NOT NULL GROUP BY 1),
joined AS (SELECT res.*, mu, sd, data_ct FROM res JOIN st USING (analysis_id) WHERE sd > 0), {_npv_sql("joined", "mu", "sd")}
SELECT analysis_id, probeset, l_orderkey, l_linenumber, data_ct, round(npv, 4) AS npv FROM scored""")
def h35_vendor_pvalue(spark, sf):
    out = AL.vendor_npv(results(spark, sf), ["analysis_id"])
    return out.select("analysis_id", "probeset", "l_orderkey", "l_linenumber", "data_ct", "npv")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'A' AND l_linestatus <> 'F' THEN l_quantity END AS estimate FROM lineitem""")
def h35_clean_vendor_file(spark, sf):
    mark = F.when(F.col("l_returnflag") == "A", ".").when(F.col("l_linestatus") == "F", "NaN").otherwise(money(F.col("l_quantity")))
    rows = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", mark.alias("estimate"))
    return AL.clean_vendor(rows, ["estimate"])


@query(f"""WITH {NPV_SQL} SELECT 'results' AS filter, analysis_id, probeset, l_orderkey, l_linenumber, fold_change, pvalue FROM scored WHERE abs(fold_change) >= 1 AND (pvalue IS NULL OR pvalue <= 0.1)
UNION ALL SELECT 'tea', analysis_id, probeset, l_orderkey, l_linenumber, fold_change, pvalue FROM scored WHERE npv <= 0.05""")
def h36_result_filters(spark, sf):
    scored = AL.add_npv(results(spark, sf), ["analysis_id"])
    both = AL.significant_results(scored).withColumn("filter", F.lit("results")).unionByName(AL.tea_results(scored).withColumn("filter", F.lit("tea")))
    return both.select("filter", "analysis_id", "probeset", "l_orderkey", "l_linenumber", "fold_change", "pvalue")


@query(f"""WITH {NPV_SQL}, m AS (SELECT p_partkey AS probeset, p_brand || p_type AS marker_id FROM part)
SELECT analysis_id, count(DISTINCT marker_id) FILTER (abs(fold_change) >= 1 AND (pvalue IS NULL OR pvalue <= 0.1)) AS n_markers, count(DISTINCT marker_id) FILTER (npv <= 0.05) AS n_tea_markers
FROM scored JOIN m USING (probeset) GROUP BY 1""")
def h37_marker_counts(spark, sf):
    links = t(spark, sf, "part", F.col("p_partkey").alias("probeset"), F.concat("p_brand", "p_type").alias("marker_id"))
    return AL.marker_counts(AL.add_npv(results(spark, sf), ["analysis_id"]), links)


@query("SELECT DISTINCT p_name || ' ' || p_size AS feature FROM part WHERE p_size >= 5")
def h38_feature_groups(spark, sf):
    part = t(spark, sf, "part", "p_name", "p_size").withColumn("probeset", F.concat_ws(" ", "p_name", F.col("p_size").cast("string")))
    return AL.feature_groups(part, part.where("p_size < 5").select(F.col("probeset").alias("feature")))


@query("""SELECT DISTINCT p_name AS feature, n_nationkey AS marker_id FROM part JOIN (SELECT n_nationkey, 'Brand#' || (n_nationkey + 1) AS symbol FROM nation) ON p_brand = symbol WHERE p_type = 'PROMO'""")
def h38_feature_markers(spark, sf):
    ann = t(spark, sf, "part", F.col("p_name").alias("probeset"), F.lower("p_brand").alias("gene_symbol"), F.col("p_type").alias("organism"))
    markers = t(spark, sf, "nation", F.col("n_nationkey").alias("marker_id"), F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 1).cast("string")).alias("symbol"), F.lit("Promo").alias("organism"))
    return AL.feature_markers(ann, markers)


# --- heat map -----------------------------------------------------------------------

HEAT_SQL = NPV_SQL + """,
one AS (SELECT analysis_id, probeset, avg(fold_change) AS fold_change, min(pvalue) AS pvalue, min(npv) AS npv, min(min_lsmean) AS min_lsmean, max(max_lsmean) AS max_lsmean FROM scored GROUP BY ALL),
cuts AS (SELECT s_suppkey AS analysis_id, 1.0 AS fc_cutoff, 0.05 AS p_cutoff, 20.0 AS mean_cutoff, s_nationkey % 5 AS cohort FROM supplier),
expr AS (SELECT l_suppkey AS assay_id, l_partkey AS probeset, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
assays AS (SELECT s_suppkey AS assay_id, s_nationkey % 5 AS cohort, 'Sub' || s_nationkey AS subject_id FROM supplier),
heat AS (SELECT 'ORD' AS study_id, o.analysis_id, 'C' || c.cohort AS cohort_id, subject_id, assay_id, o.probeset, round(v / 1000, 6) AS log_intensity, round(fold_change, 4) AS fold_change, pvalue, round(npv, 6) AS npv,
  p_size AS marker_id, 'M' || p_size AS marker_name, p_size * 10 AS gene_id, p_size + 500 AS keyword_id,
  CASE WHEN (fold_change IS NULL OR abs(fold_change) > fc_cutoff) AND coalesce(pvalue, npv) < p_cutoff AND ((min_lsmean IS NULL AND max_lsmean IS NULL) OR min_lsmean > mean_cutoff OR max_lsmean > mean_cutoff) THEN 1 ELSE 0 END AS significant
  FROM one o JOIN cuts c USING (analysis_id) JOIN assays a ON a.cohort = c.cohort JOIN expr USING (assay_id, probeset) JOIN part ON p_partkey = o.probeset WHERE p_size % 7 <> 0)"""


def heat(spark, sf):
    scored = AL.add_npv(results(spark, sf), ["analysis_id"])
    # An analysis has few results of a probe: combined after the shuffle only.
    one = scored.repartition("analysis_id", "probeset").groupBy("analysis_id", "probeset").agg(
        F.avg("fold_change").alias("fold_change"), F.min("pvalue").alias("pvalue"), F.min("npv").alias("npv"), F.min("min_lsmean").alias("min_lsmean"), F.max("max_lsmean").alias("max_lsmean")
    )
    cohort = F.concat(F.lit("C"), (F.col("s_nationkey") % 5).cast("string")).alias("cohort_id")
    study = F.lit("ORD").alias("study_id")
    supplier = t(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    part = t(spark, sf, "part", "p_partkey", "p_size")
    size = F.col("p_size")
    intensities = t(spark, sf, "lineitem", F.col("l_suppkey").alias("assay_id"), (F.col("l_partkey") + 7).alias("probeset_id"), "l_extendedprice").groupBy("assay_id", "probeset_id").agg(
        F.round(F.max("l_extendedprice") / 1000, 6).alias("log_intensity")
    )
    markers = part.select(size.alias("marker_id"), F.concat(F.lit("M"), size.cast("string")).alias("marker_name"), (size * 10).alias("gene_id")).distinct()
    out = AL.heat_map(
        intensities, supplier.select(study, cohort, F.col("s_suppkey").alias("assay_id")), supplier.select(study, cohort, F.col("s_suppkey").alias("analysis_id")),
        supplier.select(F.col("s_suppkey").alias("analysis_id"), F.lit(1.0).alias("fc_cutoff"), F.lit(0.05).alias("p_cutoff"), F.lit(20.0).alias("mean_cutoff")), one,
        part.select((F.col("p_partkey") + 7).alias("probeset_id"), F.col("p_partkey").alias("probeset")),
        supplier.select(F.col("s_suppkey").alias("assay_id"), study, F.concat(F.lit("Sub"), F.col("s_nationkey").cast("string")).alias("subject_id")),
        part.select(F.col("p_partkey").alias("feature"), size.alias("marker_id")), markers, markers.select("marker_id", (F.col("marker_id") + 500).alias("keyword_id")),
        markers.select("marker_id", F.when(F.col("marker_id") % 7 == 0, "PATHWAY").when(F.col("marker_id") % 2 == 0, "GENE").otherwise("HOMOLOGENE_GENE").alias("kind")),
    )
    return out.withColumns({"fold_change": F.round("fold_change", 4), "npv": F.round("npv", 6)})


@query(f"WITH {HEAT_SQL} SELECT * FROM heat")
def h39_heat_map(spark, sf):
    return heat(spark, sf)


@query(f"WITH {HEAT_SQL} SELECT DISTINCT analysis_id, keyword_id, 'GENE ' || marker_id AS keyword, marker_id, marker_name, gene_id, probeset, fold_change, pvalue, 'ORG' || (marker_id % 3) AS organism FROM heat")
def h39_cross_trial(spark, sf):
    keywords = t(spark, sf, "part", (F.col("p_size") + 500).alias("keyword_id"), F.concat(F.lit("gene "), F.col("p_size").cast("string")).alias("keyword")).distinct()
    markers = t(spark, sf, "part", F.col("p_size").alias("marker_id"), F.concat(F.lit("ORG"), (F.col("p_size") % 3).cast("string")).alias("organism")).distinct()
    return AL.cross_trial(heat(spark, sf), keywords, markers)


# --- links, tags, entries ------------------------------------------------------------


@query("""SELECT DISTINCT 'ORD' || o_orderstatus AS study_id, o_orderkey AS analysis_id, c AS cohort_id FROM (SELECT o_orderkey, o_orderstatus, unnest(['C' || (o_custkey % 7), 'C' || (o_custkey % 3)]) AS c FROM orders)""")
def h40_cohort_links(spark, sf):
    cust = F.col("o_custkey")
    rows = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(
        F.concat(F.lit("ord"), "o_orderstatus").alias("study_id"), F.col("o_orderkey").alias("analysis_id"),
        F.concat(F.lit("C"), (cust % 7).cast("string"), F.lit("; C"), (cust % 3).cast("string"), F.lit(";")).alias("cohorts"),
    )
    return AL.cohort_links(rows)


TAGS_SQL = """
terms AS (SELECT DISTINCT p_partkey, p_brand, category, term FROM (
  SELECT p_partkey, p_brand, 'platform' AS category, p_type AS term FROM part UNION ALL SELECT p_partkey, p_brand, 'treatment', unnest(string_split(p_name, ' ')) FROM part
  UNION ALL SELECT p_partkey, p_brand, 'organism', p_brand FROM part)),
tax AS (SELECT term_name, row_number() OVER (ORDER BY term_name) AS term_id FROM (SELECT DISTINCT lower(p_type) AS term_name FROM part WHERE p_size > 2 UNION SELECT 'red' UNION SELECT 'blue' UNION SELECT 'widget'))"""


def tag_inputs(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_brand", "p_type", "p_name", "p_size")
    records = spread(part, "p_partkey").select(
        F.col("p_brand").alias("study_id"), "p_partkey", F.col("p_type").alias("platform"), F.replace("p_name", F.lit(" "), F.lit("; ")).alias("treatment"), F.col("p_brand").alias("organism")
    )
    names = part.where("p_size > 2").select(F.lower("p_type").alias("term_name")).union(spark.createDataFrame([("red",), ("blue",), ("widget",)], "term_name string")).distinct()
    from studyflow.operators.numbering import number_rows

    taxonomy = number_rows(names, ["term_name"], slice_by=F.substring("term_name", 1, 1), out="term_id")
    return records, taxonomy


@query(f"""WITH {TAGS_SQL} SELECT DISTINCT p_brand AS study_id, p_partkey, term_id, upper(category || ':' || term) AS source FROM terms JOIN tax ON upper(term) = upper(term_name)""")
def h41_term_tags(spark, sf):
    records, taxonomy = tag_inputs(spark, sf)
    return AL.tag_terms(records, ["study_id", "p_partkey"], {"platform": None, "treatment": ";", "organism": None}, taxonomy)[0]


@query(f"""WITH {TAGS_SQL} SELECT DISTINCT upper(p_brand) AS study_id, category, term FROM terms WHERE upper(term) NOT IN (SELECT upper(term_name) FROM tax)""")
def h41_invalid_terms(spark, sf):
    records, taxonomy = tag_inputs(spark, sf)
    return AL.tag_terms(records, ["study_id", "p_partkey"], {"platform": None, "treatment": ";", "organism": None}, taxonomy)[1]


@query("""WITH tags AS (SELECT c_custkey, 100 + c_nationkey AS term_id FROM customer)
SELECT c_custkey, 100 + n_nationkey AS term_id, n_name AS term_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT c_custkey, r_regionkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def h41_term_lineage(spark, sf):
    nation, region = t(spark, sf, "nation"), t(spark, sf, "region")
    taxonomy = nation.select((F.col("n_nationkey") + 100).alias("term_id"), F.col("n_name").alias("term_name")).union(region.select("r_regionkey", "r_name"))
    relations = nation.select((F.col("n_nationkey") + 100).alias("child_id"), F.col("n_regionkey").alias("parent_id"))
    tags = t(spark, sf, "customer", "c_custkey", (F.col("c_nationkey") + 100).alias("term_id"))
    return AL.lineage(taxonomy, relations, tags)


@query("""WITH r AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'clinical' WHEN 1 THEN 'Clinical Trial' ELSE 'Survey' END AS design FROM customer)
SELECT 'CUST' AS study_id, c_custkey, a.term_id, upper('study_design:' || design) AS source, a.term_name, a.search_keyword_id
FROM r, (SELECT 7 AS term_id, 'Clinical Trial' AS term_name, 70 AS search_keyword_id UNION ALL SELECT 1, 'Design', 10) a WHERE c_custkey % 3 <> 2""")
def h41_design_alias_and_keywords(spark, sf):
    """A study design under its alias, tagged with its own term and the ancestor, both with their search keywords."""
    design = F.when(F.col("c_custkey") % 3 == 0, "clinical").when(F.col("c_custkey") % 3 == 1, "Clinical Trial").otherwise("Survey")
    records = t(spark, sf, "customer", F.lit("CUST").alias("study_id"), "c_custkey", design.alias("study_design"))
    taxonomy = spark.createDataFrame([(7, "Clinical Trial", 70), (1, "Design", 10), (8, "Clinical", None)], "term_id int, term_name string, search_keyword_id int").where("term_id <> 8")
    relations = spark.createDataFrame([(7, 1)], "child_id int, parent_id int")
    return AL.lineage(taxonomy, relations, AL.tag_terms(records, ["study_id", "c_custkey"], {"study_design": None}, taxonomy)[0])


@query("""SELECT n AS n_entries, n AS n_delivered, true AS complete FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0)""")
def h42_entry_refresh(spark, sf):
    from studyflow.plans.sets_demo import old_and_new

    return AL.refresh_entries(*old_and_new(spark, sf), ["k"], ["status", "price"])[1]


@query("""SELECT DISTINCT s_nationkey, 'GPL' || x AS platform, 'vendor ' || x AS vendor FROM (SELECT s_nationkey, unnest([s_suppkey % 3, s_suppkey % 5]) AS x FROM supplier)""")
def h43_platform_rows(spark, sf):
    def both(prefix):
        return F.concat(F.lit(prefix), (F.col("s_suppkey") % 3).cast("string"), F.lit("; " + prefix), (F.col("s_suppkey") % 5).cast("string"))

    rows = t(spark, sf, "supplier", "s_suppkey", "s_nationkey").select("s_nationkey", both("GPL").alias("platforms"), both("vendor ").alias("vendors"))
    return AL.platform_rows(rows, {"platforms": "platform", "vendors": "vendor"}, ["s_nationkey"])


PROJECT_SQL = """
p AS (SELECT CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 'PRJ' || s_nationkey END AS accession, CASE WHEN s_suppkey % 7 <> 0 THEN 'A' || s_suppkey END AS analysis, 'D' || s_suppkey % 4 AS dataset, s_suppkey, s_nationkey FROM supplier),
e AS (SELECT DISTINCT accession FROM p WHERE accession IS NOT NULL)"""


def project(spark, sf):
    key = lambda n: (F.col("s_suppkey") % n).cast("string")
    rows = t(spark, sf, "supplier", "s_suppkey", "s_nationkey").select(
        F.when(F.col("s_suppkey") % 10 != 0, F.concat(F.lit(" prj"), F.col("s_nationkey").cast("string"))).alias("accession"), F.lit("title").alias("title"),
        F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit("A"), F.col("s_suppkey").cast("string"))).alias("analysis"), F.concat(F.lit("D"), key(4)).alias("dataset"),
        F.concat(F.lit("Drug"), key(3), F.lit("; drug"), key(5)).alias("compounds"), F.concat(F.lit("Ill"), key(2)).alias("diseases"),
    )
    known = {
        "experiment": spark.createDataFrame([(5, "PRJ1", "old")], "experiment_id long, accession string, title string"),
        "analysis": spark.createDataFrame([], "analysis_id long, experiment_id long, analysis string"), "dataset": spark.createDataFrame([], "dataset_id long, analysis_id long, dataset string"),
        "compound": spark.createDataFrame([(1, "Drug0"), (1, "DRUG1"), (2, "drug2"), (3, "drug3")], "compound_id long, name string"),
        "disease": spark.createDataFrame([(1, "ill0"), (2, "ill1")], "disease_id long, name string"),
    }
    return AL.load_project(rows, known)


@query(rf"""WITH {PROJECT_SQL}
SELECT 'experiment' AS entity, accession, accession AS value FROM e UNION ALL SELECT 'experiment', 'PRJ1', 'PRJ1' WHERE 'PRJ1' NOT IN (SELECT accession FROM e)
UNION ALL SELECT DISTINCT 'analysis', accession, analysis FROM p WHERE accession IS NOT NULL AND analysis IS NOT NULL
UNION ALL SELECT DISTINCT 'dataset', accession, analysis || ' ' || dataset FROM p WHERE accession IS NOT NULL AND analysis IS NOT NULL
UNION ALL SELECT DISTINCT 'compound', accession, CASE x WHEN 0 THEN '1' WHEN 1 THEN '1' ELSE CAST(x AS VARCHAR) END FROM (SELECT accession, unnest([s_suppkey % 3, s_suppkey % 5]) AS x FROM p WHERE accession IS NOT NULL) WHERE x < 4
UNION ALL SELECT DISTINCT 'disease', accession, CAST(s_suppkey % 2 + 1 AS VARCHAR) FROM p WHERE accession IS NOT NULL""")
def h43_project_entities(spark, sf):
    """All five tables, every row with the accession that its ids lead back to."""
    out = project(spark, sf)
    experiment = out["experiment"].select("experiment_id", "accession")
    analysis = out["analysis"].join(experiment, "experiment_id")
    rows = [
        experiment.select(F.lit("experiment").alias("entity"), "accession", F.col("accession").alias("value")),
        analysis.select(F.lit("analysis").alias("entity"), "accession", F.col("analysis").alias("value")),
        out["dataset"].join(analysis, "analysis_id").select(F.lit("dataset").alias("entity"), "accession", F.concat_ws(" ", "analysis", "dataset").alias("value")),
        *[out[f"experiment_{k}"].join(experiment, "experiment_id").select(F.lit(k).alias("entity"), "accession", F.col(f"{k}_id").cast("string").alias("value")) for k in ("compound", "disease")],
    ]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return whole


@query(rf"""WITH {PROJECT_SQL}
SELECT DISTINCT 'experiment' AS step, accession, coalesce(analysis, 'title') AS value FROM p WHERE accession IS NULL
UNION ALL SELECT DISTINCT 'dataset', accession, dataset FROM p WHERE accession IS NOT NULL AND analysis IS NULL
UNION ALL SELECT DISTINCT 'compound', accession, 'drug4' FROM p WHERE accession IS NOT NULL AND s_suppkey % 5 = 4""")
def h43_project_rejects(spark, sf):
    return project(spark, sf)["rejects"]


@query(f"""WITH {RAW_SQL} SELECT 'ORD' AS study_id, analysis_id, probeset, try_cast(preferred_pvalue AS DOUBLE) AS preferred_pvalue, try_cast(fold_change AS DOUBLE) AS fold_change FROM raw""")
def h44_comparison_data(spark, sf):
    from studyflow.operators.routing import numeric_or_null, set_constants

    rows = raw_results(spark, sf).select("analysis_id", "probeset", "preferred_pvalue", "fold_change")
    return set_constants(numeric_or_null(rows, ["preferred_pvalue", "fold_change"]), {"study_id": "ORD"})


@query("""SELECT s_name AS file_name, 'Study ' || s_suppkey AS title, CASE WHEN s_nationkey % 2 = 0 THEN 'nation=' || s_nationkey END AS platform, CAST(NULL AS VARCHAR) AS institution FROM supplier""")
def h48_project_file(spark, sf):
    nation = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("nation="), F.col("s_nationkey").cast("string"))).otherwise(".")
    lines = t(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey").select(
        F.col("s_name").alias("file_name"), F.explode(F.array(
            F.concat(F.lit("title = Study "), F.col("s_suppkey").cast("string")), F.concat(F.lit("platform="), nation), F.lit("# comment"), F.lit("institution=.")
        )).alias("line"),
    )
    return AL.project_rows(lines, ["title", "platform", "institution"])
