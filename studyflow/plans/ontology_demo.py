"""Queries of vocabularies, study metadata and the search index."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.operators import analysis as AL
from studyflow.operators import merge as M
from studyflow.operators import melt as ML
from studyflow.operators import ontology as O
from studyflow.operators import search as SE
from studyflow.plans.data import money, t
from studyflow.plans.registry import query
from studyflow.session import work_path


def text(c):
    return F.col(c).cast("string")


# --- study metadata ------------------------------------------------------------


@query("""SELECT s_name AS study_id, 'nation ' || s_nationkey AS title, CASE WHEN s_suppkey % 4 <> 0 THEN printf('%.2f', s_acctbal) END AS budget, CAST(NULL AS VARCHAR) AS country FROM supplier""")
def i01_metadata_row(spark, sf):
    return O.metadata_row(_pairs(spark, sf), ["title", "budget", "country"], ["title", "budget"], ["study_id"])[0]


@query("SELECT s_name AS study_id, 'budget' AS missing_fields FROM supplier WHERE s_suppkey % 4 = 0")
def i01_missing_fields(spark, sf):
    return O.metadata_row(_pairs(spark, sf), ["title", "budget", "country"], ["title", "budget"], ["study_id"])[1]


def _pairs(spark, sf):
    supplier = t(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")

    def pair(name, value):
        return F.struct(F.lit(name).alias("column_name"), value.alias("value"))

    cells = F.array(
        pair("title", F.concat(F.lit("nation "), text("s_nationkey"))), pair("budget", F.when(F.col("s_suppkey") % 4 != 0, money(F.col("s_acctbal")))), pair("unknown", F.lit("x"))
    )
    return supplier.select(F.col("s_name").alias("study_id"), F.inline(cells))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS n_patients,
  coalesce(nullif(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END || CASE WHEN o_orderkey % 2 = 0 THEN ' Inclusion Criteria: ' || o_orderstatus ELSE '' END
    || CASE WHEN o_orderkey % 4 = 0 THEN ' Exclusion Criteria: none' ELSE '' END, ''), 'overall') AS overall_design FROM orders""")
def i02_typed_metadata(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority").select(
        "o_orderkey", F.when(k % 3 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("start_date"),
        F.when(k % 5 == 0, "many").otherwise(text("o_custkey")).alias("n_patients"),
        O.overall_design(
            F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_orderpriority")), F.when(k % 2 == 0, F.col("o_orderstatus")),
            F.when(k % 4 == 0, "none").otherwise("N/A"), F.lit("overall"),
        ).alias("overall_design"),
    )
    return O.typed_metadata(rows, ["start_date"], ["n_patients"])


@query("""WITH n AS (SELECT o_orderkey, o_orderdate, o_custkey, o_orderpriority, o_orderkey % 2 = 0 AS known, o_orderkey % 3 <> 0 AS delivered FROM orders)
SELECT 'S' || o_orderkey AS study_id, CASE WHEN NOT delivered THEN DATE '2000-01-01' WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date, CASE WHEN NOT delivered THEN 1.0 WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS n_patients,
  CASE WHEN NOT delivered THEN 'old' ELSE substr(o_orderpriority || ' design', 1, 8) END AS design FROM n WHERE known OR delivered""")
def i02_metadata_upsert(spark, sf):
    k = F.col("o_orderkey")
    orders = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    study = F.concat(F.lit("S"), text("o_orderkey")).alias("study_id")
    known = orders.where(k % 2 == 0).select(study, F.lit("2000-01-01").cast("date").alias("start_date"), F.lit(1.0).alias("n_patients"), F.lit("old").alias("design"))
    landing = orders.where(k % 3 != 0).select(
        study, F.when(k % 5 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("start_date"), F.when(k % 7 == 0, "many").otherwise(text("o_custkey")).alias("n_patients"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" design ")).alias("design"),
    )
    return O.upsert_metadata(known, landing, "study_id", ["start_date"], ["n_patients"], {"design": 8})


COMPOUND_SQL = """items AS (SELECT p_brand AS study_id, trim(unnest(string_split(p_name, ' '))) AS name FROM part)"""


def _studies(spark, sf):
    return t(spark, sf, "part", F.col("p_brand").alias("study_id"), F.replace("p_name", F.lit(" "), F.lit("; ")).alias("compounds"))


@query(f"WITH {COMPOUND_SQL} SELECT upper(name) AS key, min(name) AS name FROM items WHERE upper(name) NOT IN ('RED', 'BOLT') GROUP BY 1")
def i03_new_dictionary_names(spark, sf):
    known = spark.createDataFrame([("Red",), ("BOLT",)], "name string")
    return O.dictionary_links(_studies(spark, sf), "compounds", known)[0]


@query(f"WITH {COMPOUND_SQL} SELECT DISTINCT study_id, upper(name) AS key FROM items")
def i03_dictionary_links(spark, sf):
    known = spark.createDataFrame([("Red",)], "name string")
    return O.dictionary_links(_studies(spark, sf), "compounds", known)[1]


@query("""SELECT 'GSE' || page_id AS study_id, 'GEO' AS kind, 'GSE' || page_id AS target, CAST(NULL AS VARCHAR) AS title FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT CASE WHEN page_id % 2 = 0 THEN 'GSE' ELSE 'X' END || page_id, 'PUBMED', CAST(page_id AS VARCHAR), 'paper ' || page_id FROM pages
UNION ALL SELECT CASE WHEN page_id % 2 = 0 THEN 'GSE' ELSE 'X' END || page_id, 'PUBMED', '77', 'review' FROM pages""")
def i04_external_links(spark, sf):
    prefix = F.when(F.col("page_id") % 2 == 0, "GSE").otherwise("X")
    rows = t(spark, sf, "pages", "page_id").select(
        F.concat(prefix, text("page_id")).alias("study_id"), F.concat(text("page_id"), F.lit(": paper "), text("page_id"), F.lit(";77:review")).alias("pubmed")
    )
    return O.external_links(rows)


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_studies FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) <> 1")
def i05_one_study_report(spark, sf):
    return O.one_study_report(t(spark, sf, "lineitem", "l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey")


# --- vocabularies ----------------------------------------------------------------


def mesh_records(spark, sf):
    path = work_path(spark, "headings")
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    record = F.concat(
        F.lit("\nRECTYPE = D\nMH = "), "p_name", F.lit("\nPRINT ENTRY = no\nENTRY = "), "p_brand", F.lit("|T047|x\nENTRY = "), "p_type", F.lit("\nMN = C"), text("p_size"),
        F.lit(".1\nMN = D"), text("p_size"), F.lit("\nUI = D"), text("p_partkey"), F.lit("\n\n"),
    )
    part.select(F.concat(F.lit("*NEWRECORD"), record).alias("value")).write.option("lineSep", "\n").text(path)
    return O.read_records(spark, path, O.MESH_RECORD)


@query("""SELECT 'D' || p_partkey AS ui, p_name AS mh, 'D' || p_size AS mn FROM part WHERE starts_with('C' || p_size || '.1', 'C1') OR p_size = 7""")
def i06_mesh_headings(spark, sf):
    return O.mesh_headings(mesh_records(spark, sf), ["C1", "C7."])


@query("SELECT p_name AS mh, p_brand AS entry FROM part UNION ALL SELECT p_name, p_type FROM part")
def i06_mesh_synonyms(spark, sf):
    return O.mesh_synonyms(mesh_records(spark, sf))


def gene_lines(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    synonyms = F.when(F.col("p_size") % 3 == 0, "-").otherwise(F.replace("p_name", F.lit(" "), F.lit("|")))
    return part.select(F.concat_ws(
        "\t", F.when(F.col("p_size") % 2 == 0, "9606").otherwise("7227"), text("p_partkey"), "p_brand", F.lit("-"), synonyms, F.lit("-"), F.lit("1"), F.lit("q"), "p_type"
    ).alias("line"))


@query("SELECT '9606' AS tax_id, CAST(p_partkey AS VARCHAR) AS gene_id, p_brand AS symbol, p_type AS description FROM part WHERE p_size % 2 = 0")
def i07_genes(spark, sf):
    return O.gene_info(gene_lines(spark, sf), ["9606", "10090"])[0]


@query("SELECT '9606' AS tax_id, CAST(p_partkey AS VARCHAR) AS gene_id, p_brand AS symbol, unnest(string_split(p_name, ' ')) AS synonym FROM part WHERE p_size % 2 = 0 AND p_size % 3 <> 0")
def i07_gene_synonyms(spark, sf):
    return O.gene_info(gene_lines(spark, sf), ["9606", "10090"])[1]


@query("""SELECT CAST(c_custkey AS VARCHAR) AS tax_id, c_name AS name, '' AS unique_name, CASE WHEN c_custkey % 3 = 0 THEN 'synonym' ELSE 'scientific name' END AS name_class FROM customer""")
def i08_taxonomy_names(spark, sf):
    kind = F.when(F.col("c_custkey") % 3 == 0, "synonym").otherwise("scientific name")
    lines = t(spark, sf, "customer", "c_custkey", "c_name").select(F.concat_ws("\t|\t", text("c_custkey"), "c_name", F.lit(""), F.concat(kind, F.lit("\t|"))).alias("line"))
    return O.taxonomy_names(lines)


@query("SELECT 'GO:' || p_partkey AS term_id, p_name AS term_name FROM part")
def i09_ontology_terms(spark, sf):
    path = work_path(spark, "terms")
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_type")
    part.select(F.concat(F.lit("[Term]\nid: GO:"), text("p_partkey"), F.lit("\nname: "), "p_name", F.lit("\nnamespace: "), "p_type", F.lit("\n")).alias("value")).write.text(path)
    return O.ontology_terms(O.read_records(spark, path, O.TERM_RECORD))


@query("""WITH pairs AS (SELECT DISTINCT 'GO:' || l_partkey % 97 AS term_id, 'S' || l_suppkey AS symbol FROM lineitem)
SELECT 'result' AS outcome, term_id, CAST(substr(symbol, 2) AS BIGINT) AS gene_id, symbol, 'Homo sapiens' AS organism FROM pairs WHERE CAST(substr(symbol, 2) AS BIGINT) % 4 <> 0
UNION ALL SELECT 'reject', term_id, NULL, symbol, NULL FROM pairs WHERE CAST(substr(symbol, 2) AS BIGINT) % 4 = 0""")
def i09_gene_associations(spark, sf):
    lines = t(spark, sf, "lineitem", "l_partkey", "l_suppkey").select(F.concat_ws(
        "\t", F.lit("DB"), F.lit("acc"), F.concat(F.lit("S"), text("l_suppkey")), F.lit(""), F.concat(F.lit("GO:"), (F.col("l_partkey") % 97).cast("string"))
    ).alias("line"))
    genes = t(spark, sf, "supplier", F.concat(F.lit("S"), text("s_suppkey")).alias("symbol"), F.col("s_suppkey").alias("gene_id")).where("gene_id % 4 <> 0")
    result, reject = O.gene_associations(lines, genes, "Homo sapiens")
    return result.withColumn("outcome", F.lit("result")).unionByName(reject.withColumn("outcome", F.lit("reject")), allowMissingColumns=True)


@query("SELECT 'hsa' || p_size AS pathway, CAST(p_partkey AS VARCHAR) AS gene_id, split_part(p_name, ' ', 1) AS symbol FROM part WHERE p_size % 5 <> 0")
def i10_pathway_genes(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_size")
    full = F.concat_ws("\t", F.concat(F.lit("path:hsa"), text("p_size")), F.concat(F.lit("hsa:"), text("p_partkey")), F.concat(F.lit("hsa:"), "p_name"))
    return O.pathway_genes(part.select(F.when(F.col("p_size") % 5 == 0, F.lit("two\tcolumns")).otherwise(full).alias("line")))


@query("""SELECT 'hsa' || p_partkey AS pathway, p_name AS title FROM part WHERE p_size % 2 = 0
UNION ALL SELECT * FROM (VALUES ('hsa01100', 'Metabolic pathways'), ('hsa05131', 'Shigellosis'), ('hsa05200', 'Pathways in cancer')) v(a, b)""")
def i10_pathway_definitions(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_size")
    good = F.concat_ws("\t", F.lit("rect"), F.lit("/kegg?hsa"), F.concat(F.lit("hsa"), text("p_partkey"), F.lit(": "), "p_name"))
    return O.pathway_definitions(part.select(F.when(F.col("p_size") % 2 == 0, good).otherwise("rect\thsa:1\tx").alias("line")))


@query("""WITH g AS (SELECT p_partkey, p_name, unnest([p_size, p_size + 1]) AS gene FROM part), d AS (SELECT DISTINCT p_size AS gene FROM part WHERE p_size % 3 <> 0)
SELECT 'member' AS outcome, 'ING:' || p_partkey AS pathway, CAST(gene AS VARCHAR) AS gene_id, 'S' || gene AS symbol FROM g WHERE gene IN (SELECT gene FROM d)
UNION ALL SELECT 'reject', 'ING:' || p_partkey, CAST(gene AS VARCHAR), NULL FROM g WHERE gene NOT IN (SELECT gene FROM d)
UNION ALL SELECT 'definition', 'ING:' || p_partkey, NULL, 'SIGNALING: ' || p_name FROM part""")
def i10_gene_list_pathways(spark, sf):
    path = work_path(spark, "gene-lists")
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_size")
    part.select(F.concat(
        F.lit("ING:"), text("p_partkey"), F.lit("\tSIGNALING: "), "p_name", F.lit(',\tx\ty\t"'), text("p_size"), F.lit(",\n "), (F.col("p_size") + 1).cast("string"), F.lit('"')
    ).alias("value")).write.text(path)
    genes = part.where("p_size % 3 <> 0").select(text("p_size").alias("gene_id"), F.concat(F.lit("S"), text("p_size")).alias("symbol")).distinct()
    definitions, members, rejects = O.gene_list_pathways(O.pathway_records(spark, path), genes)
    parts = [
        members.withColumn("outcome", F.lit("member")), rejects.withColumn("outcome", F.lit("reject")),
        definitions.select("pathway", F.col("title").alias("symbol"), F.lit("definition").alias("outcome")),
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True).select("outcome", "pathway", "gene_id", "symbol")


@query("""SELECT DISTINCT s_nationkey AS pathway_id, p_size AS marker_id, 'PATHWAY GENE' AS kind FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE NOT (s_nationkey = 3 AND p_size > 20)""")
def i11_pathway_edges(spark, sf):
    lines = t(spark, sf, "lineitem", "l_partkey", "l_suppkey")
    supplier, part = t(spark, sf, "supplier", "s_suppkey", "s_nationkey"), t(spark, sf, "part", "p_partkey", "p_size")
    gene = F.concat(F.lit("g"), F.col("p_size").cast("string"))
    pairs = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("path"), text("s_nationkey")).alias("pathway"), gene.alias("symbol")
    )
    pathways = supplier.select(F.upper(F.concat(F.lit("path"), text("s_nationkey"))).alias("pathway"), F.col("s_nationkey").alias("pathway_id"), F.lit("Homo sapiens").alias("organism")).distinct()
    markers = part.select(F.upper(gene).alias("symbol"), F.lit("HOMO SAPIENS").alias("organism"), F.col("p_size").alias("marker_id")).distinct()
    known = markers.where("marker_id > 20").select(F.lit(3).alias("pathway_id"), "marker_id")
    return O.correlations(pairs, pathways, markers, known, "PATHWAY GENE")


@query("""SELECT o_orderpriority || o_custkey AS name, max(o_orderstatus) AS code, 'd' AS description, 'obs' AS type, 'MeSH' AS source FROM orders GROUP BY ALL""")
def i12_observations(spark, sf):
    rows = t(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderstatus").select(
        F.concat_ws("\t", F.concat(F.lit('"'), "o_orderpriority", text("o_custkey"), F.lit('"')), "o_orderstatus", F.lit("d"), F.lit("obs"), F.lit("")).alias("line")
    )
    return O.observations(rows, "MeSH")[0]


# --- search -------------------------------------------------------------------------


@query("SELECT 'SUBJECT:' || c_custkey AS unique_id, 'SUBJECT' AS kind FROM customer WHERE c_custkey % 3 <> 0")
def i13_unique_ids(spark, sf):
    customer = t(spark, sf, "customer", "c_custkey")
    known = customer.where("c_custkey % 3 = 0").select(F.concat(F.lit("SUBJECT:"), text("c_custkey")).alias("unique_id"))
    return SE.unique_ids(customer, F.col("c_custkey"), "SUBJECT", known)


@query("""SELECT DISTINCT p_size AS owner_id, p_name AS code, 'Alias' AS code_source, 'SYNONYM' AS code_type, 'GENE' AS kind FROM part WHERE p_name NOT LIKE 'red%'""")
def i13_external_codes(spark, sf):
    part = t(spark, sf, "part", "p_size", "p_name")
    owners = part.select(F.col("p_size").alias("mh"), F.col("p_size").alias("owner_id")).distinct()
    synonyms = part.select(F.col("p_size").alias("mh"), F.col("p_name").alias("code"))
    known = part.where("p_name like 'red%'").select(F.col("p_size").alias("owner_id"), F.col("p_name").alias("code"))
    return SE.ext_codes(synonyms, owners, "mh", "GENE", known)


KEYWORD_SQL = """
old AS (SELECT c_custkey + 1 AS keyword_id, lower(c_name) AS keyword, 'SUBJECT' AS category FROM customer WHERE c_custkey % 2 = 0),
kw AS (SELECT * FROM old UNION ALL SELECT (SELECT max(keyword_id) FROM old) + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name), c_name, 'SUBJECT' FROM customer WHERE c_custkey % 2 = 1)"""


def keywords(spark, sf):
    customer = t(spark, sf, "customer", "c_custkey", "c_name")
    old = customer.where("c_custkey % 2 = 0").select((F.col("c_custkey") + 1).alias("keyword_id"), F.lower("c_name").alias("keyword"), F.lit("SUBJECT").alias("category"))
    return SE.add_keywords(old, customer.select(F.col("c_name").alias("name")), "SUBJECT")


@query(f"WITH {KEYWORD_SQL} SELECT * FROM kw")
def i14_keywords(spark, sf):
    return keywords(spark, sf)


@query(f"""WITH {KEYWORD_SQL} SELECT keyword_id, upper(keyword) AS term, 1 AS rank, CAST(length(keyword) AS INTEGER) AS term_length FROM kw
UNION ALL SELECT keyword_id, 'SUBJECT ' || keyword_id, 2, CAST(length('SUBJECT ' || keyword_id) AS INTEGER) FROM kw""")
def i14_keyword_terms(spark, sf):
    index = keywords(spark, sf)
    return SE.keyword_terms(index, index.select("keyword_id", F.concat(F.lit("subject "), text("keyword_id")).alias("synonym")))


TAXONOMY_SQL = """
tax AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS term_id, n_name AS term_name FROM nation),
fresh AS (SELECT c_name AS term_name, (SELECT max(term_id) FROM tax) + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) AS term_id FROM customer)"""


def taxonomy(spark, sf):
    tax = t(spark, sf, "nation", (F.col("n_nationkey") + 1).cast("long").alias("term_id"), F.col("n_name").alias("term_name"))
    customer = t(spark, sf, "customer", "c_name", "c_nationkey")
    requested = customer.select(F.col("c_name").alias("term"), F.concat(F.lit("nation_"), text("c_nationkey")).alias("parent"))
    return SE.add_taxonomy_terms(tax, requested)


@query(f"WITH {TAXONOMY_SQL} SELECT * FROM tax UNION ALL SELECT term_id, term_name FROM fresh")
def i15_taxonomy_terms(spark, sf):
    return taxonomy(spark, sf)[0]


@query(f"WITH {TAXONOMY_SQL} SELECT f.term_id AS child_id, t.term_id AS parent_id FROM customer JOIN fresh f ON c_name = f.term_name JOIN tax t ON t.term_id = c_nationkey + 1")
def i15_taxonomy_relations(spark, sf):
    return taxonomy(spark, sf)[1]


@query("""SELECT rec, 'TISSUE' AS category, kind AS category_value FROM (SELECT o_orderkey AS rec, o_orderpriority AS kind FROM orders)
UNION ALL SELECT o_orderkey, 'STATE', o_orderstatus FROM orders UNION ALL SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'ORIGIN' ELSE 'SITE' END, CASE WHEN o_custkey % 2 = 0 THEN 'bank' ELSE 'clinic' END FROM orders""")
def i16_sample_categories(spark, sf):
    rows = t(spark, sf, "orders", F.col("o_orderkey").alias("rec"), "o_orderpriority", "o_orderstatus")
    mapping = spark.createDataFrame([(1, "Tissue"), (2, "State")], "column_number int, category string")
    whole = spark.createDataFrame([(0, "Origin", "bank"), (1, "Site", "clinic")], "study_id long, category string, category_value string")
    studies = t(spark, sf, "orders", F.col("o_orderkey").alias("rec"), (F.col("o_custkey") % 2).alias("study_id"))
    return O.sample_categories(ML.to_cells(rows, "rec", ["o_orderpriority", "o_orderstatus"]), mapping, "rec", study_level=whole, studies=studies)


@query("""SELECT o_orderkey, CASE WHEN flag IN ('new', 'changed') AND o_orderkey % 10 = 3 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus, o_orderpriority, flag
FROM (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'new' WHEN o_orderkey % 6 = 1 THEN 'deleted' WHEN o_orderkey % 10 = 3 THEN 'changed' ELSE 'identical' END AS flag FROM orders)""")
def i17_metadata_refresh(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    new = rows.where(~((k % 4 != 0) & (k % 6 == 1))).withColumn("o_orderstatus", F.when(k % 10 == 3, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")))
    return M.diff(rows.where(k % 4 != 0), new, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query("SELECT page_id AS pathway_id, 'http://pathways/' || url AS location FROM pages WHERE page_id % 5 <> 0")
def i18_content_links(spark, sf):
    pages = t(spark, sf, "pages", F.col("page_id").alias("pathway_id"), F.col("url").alias("external_id"))
    known = pages.where("pathway_id % 5 = 0").select(F.concat(F.lit("http://pathways/"), "external_id").alias("location"))
    return SE.content_links(pages, "http://pathways/", known)


@query("""SELECT s_name AS study_id, CASE WHEN s_suppkey % 5 <> 0 THEN 'Study of ' || s_name END AS title, CASE WHEN s_suppkey % 5 <> 0 THEN 'loaded' ELSE 'reject' END AS outcome FROM supplier""")
def i19_header_metadata(spark, sf):
    rows = t(spark, sf, "supplier", "s_suppkey", "s_name").select(
        F.col("s_name").alias("study_id"), F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("Study of "), "s_name")).alias("title")
    )
    good, bad = O.header_metadata(rows)
    return good.withColumn("outcome", F.lit("loaded")).unionByName(bad.withColumn("outcome", F.lit("reject")))
