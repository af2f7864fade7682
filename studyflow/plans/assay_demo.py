"""Queries of assay processing: order lines as intensities, orders as samples, parts as probes."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.functions import text as T
from studyflow.functions.paths import SEP
from studyflow.operators import annotation as AN
from studyflow.operators import assay as A
from studyflow.operators import tree as TR
from studyflow.operators.joins import first_by
from studyflow.operators.numbering import surrogate_ids
from studyflow.operators.routing import numeric_only, strip_and_map_samples
from studyflow.plans.data import t
from studyflow.plans.registry import query
from studyflow.session import staged
from studyflow.sources.tables import spread

TOP = "\\Public Studies\\Ord\\"

# --- sample map ------------------------------------------------------------------

SAMPLES_SQL = """
samples AS (
  SELECT 'ord' AS study_id, CASE WHEN o_custkey % 5 <> 0 THEN 'N' || (o_custkey % 5) END AS site_id, CAST(o_custkey AS VARCHAR) AS subject_id,
    'S' || o_orderkey AS sample_cd, 'GPL' || (o_orderkey % 3) AS platform, 'Chip ' || (o_orderkey % 3) AS title, o_orderpriority AS tissue_type,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS attribute_1, CASE WHEN o_orderkey % 4 <> 0 THEN 'Y' || year(o_orderdate) END AS attribute_2,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Bio_Data+PLATFORM+TISSUETYPE+ATTR1+ATTR2' ELSE 'Bio_Data+TISSUETYPE+PLATFORM+ATTR1' END AS category_cd,
    CASE WHEN o_orderkey % 10 = 0 THEN 'EXT' ELSE 'STD' END AS source_cd FROM orders)"""


def samples(spark, sf):
    o = spread(t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"), "o_orderkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def tag(prefix, c):
        return F.concat(F.lit(prefix), c.cast("string"))

    return o.select(
        F.lit("ord").alias("study_id"), F.when(cust % 5 != 0, tag("N", cust % 5)).alias("site_id"), cust.cast("string").alias("subject_id"),
        tag("S", key).alias("sample_cd"), tag("GPL", key % 3).alias("platform"), tag("Chip ", key % 3).alias("title"),
        F.col("o_orderpriority").alias("tissue_type"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("attribute_1"),
        F.when(key % 4 != 0, tag("Y", F.year("o_orderdate"))).alias("attribute_2"),
        F.when(key % 2 == 0, "Bio_Data+PLATFORM+TISSUETYPE+ATTR1+ATTR2").otherwise("Bio_Data+TISSUETYPE+PLATFORM+ATTR1").alias("category_cd"),
        F.when(key % 10 == 0, "EXT").otherwise("STD").alias("source_cd"),
    )


@query(f"""WITH {SAMPLES_SQL}, s AS (SELECT * REPLACE (CASE WHEN attribute_2 IS NULL THEN NULL ELSE subject_id END AS subject_id, CASE WHEN attribute_1 IS NULL THEN NULL ELSE tissue_type END AS tissue_type) FROM samples)
SELECT 'subject_missing' AS "check", count(*) FILTER (subject_id IS NULL) AS n_rows FROM s UNION ALL SELECT 'sample_missing', count(*) FILTER (sample_cd IS NULL) FROM s
UNION ALL SELECT 'platform_missing', count(*) FILTER (platform IS NULL) FROM s UNION ALL SELECT 'tissue_missing', count(*) FILTER (tissue_type IS NULL) FROM s
UNION ALL SELECT 'platform_unknown', count(*) FILTER (platform <> 'GPL0') FROM s UNION ALL SELECT 'platform_without_probes', count(*) FILTER (platform = 'GPL2') FROM s
UNION ALL SELECT 'category_without_platform', 0 UNION ALL SELECT 'several_platforms', count(*) FROM (SELECT subject_id FROM samples GROUP BY 1 HAVING count(DISTINCT platform) > 1)""")
def h01_sample_map_report(spark, sf):
    rows = samples(spark, sf)
    platforms = spark.createDataFrame(
        [("GPL0", "Gene Expression", "Chip 0"), ("GPL1", "SNP", "Chip 1"), ("GPL2", "Gene Expression", None)], "platform string, marker_type string, title string"
    )
    probes = t(spark, sf, "part", F.concat(F.lit("GPL"), (F.col("p_partkey") % 2).cast("string")).alias("platform"))
    broken = rows.withColumns({
        "subject_id": F.when(F.col("attribute_2").isNotNull(), F.col("subject_id")), "tissue_type": F.when(F.col("attribute_1").isNotNull(), F.col("tissue_type")),
    })
    report = A.sample_map_report(broken, platforms, probes).where("check <> 'several_platforms'")
    several = A.sample_map_report(rows.withColumn("sample_cd", F.col("subject_id")), platforms, probes).where("check = 'several_platforms'")
    return report.unionByName(several)


SUBJECT_SQL = "regexp_replace('ORD:' || coalesce(site_id, '') || ':' || subject_id, '(::)+', ':', 'g')"


@query(f"""WITH {SAMPLES_SQL}, have AS (SELECT DISTINCT {SUBJECT_SQL} AS subject_key FROM samples WHERE tissue_type = '1-URGENT')
SELECT row_number() OVER (ORDER BY substr(md5(subject_key), 1, 3), subject_key) + (SELECT count(*) FROM have) AS patient_num, subject_key, 'Unknown' AS sex, 0 AS age, CAST(NULL AS VARCHAR) AS race
FROM (SELECT DISTINCT {SUBJECT_SQL} AS subject_key FROM samples) WHERE subject_key NOT IN (SELECT subject_key FROM have)""")
def h02_missing_subjects(spark, sf):
    rows = samples(spark, sf)
    have = rows.where("tissue_type = '1-URGENT'").select(T.subject_key(F.lit("ORD"), "site_id", "subject_id").alias("subject_key")).distinct()
    return A.missing_subjects(rows, surrogate_ids(have, ["subject_key"], "patient_num"), "ORD")


def _role_sql(role, cut, when):
    filled = cut
    for token, column in A.ROLE_TOKENS.items():
        filled = f"replace({filled}, '{token}', coalesce({column}, ''))"
    return (
        f"SELECT *, '{role}' AS role, regexp_replace('{TOP}' || replace(replace({filled}, '_', ' '), '+', '\\') || '\\', '(\\\\){{2,}}', '\\\\', 'g') AS node_path FROM samples WHERE {when}"
    )


ROLES_SQL = SAMPLES_SQL + ", roles AS (" + " UNION ALL ".join(
    [_role_sql("LEAF", "category_cd", "true")] + [
        _role_sql(tok, f"substr(category_cd, 1, instr(category_cd, '{tok}') + {len(tok)})", f"contains(category_cd, '{tok}') AND {col} IS NOT NULL")
        for tok, col in A.ROLE_TOKENS.items()
    ]
) + ")"


@query(rf"WITH {ROLES_SQL} SELECT DISTINCT node_path, role, string_split(node_path, '\')[-2] AS name FROM roles")
def h03_sample_nodes(spark, sf):
    return A.sample_nodes(samples(spark, sf), TOP)


@query(rf"""WITH {SAMPLES_SQL.replace("'Chip ' || (o_orderkey % 3) AS title", "CASE o_orderkey % 3 WHEN 0 THEN 'Array A' WHEN 1 THEN 'Array B' END AS title").replace("FROM orders)", "FROM orders WHERE o_orderkey % 3 <> 2)")}{ROLES_SQL.removeprefix(SAMPLES_SQL)}
SELECT DISTINCT node_path, role, string_split(node_path, '\')[-2] AS name FROM roles""")
def h03_sample_nodes_by_platform(spark, sf):
    """Titles and marker types from the platform table: one of the three platforms holds other markers."""
    platforms = spark.createDataFrame([("GPL0", "Array A", "Gene Expression"), ("GPL1", "Array B", "GENE EXPRESSION"), ("GPL1", "Array C", "Gene Expression"), ("GPL2", "Chip", "SNP")], "platform string, title string, marker_type string")
    return A.sample_nodes(samples(spark, sf), TOP, platforms)


MAPPING_SQL = ROLES_SQL + f""",
patients AS (SELECT subject_key, row_number() OVER (ORDER BY substr(md5(subject_key), 1, 3), subject_key) AS patient_num FROM (SELECT DISTINCT {SUBJECT_SQL} AS subject_key FROM samples)),
concepts AS (SELECT node_path, row_number() OVER (ORDER BY substr(md5(node_path), 1, 3), node_path) AS concept_cd FROM (SELECT DISTINCT node_path FROM roles)),
mapping AS (
  SELECT site_id, subject_id, sample_cd, platform, tissue_type, attribute_1, attribute_2, category_cd, any_value({SUBJECT_SQL}) AS subject_key,
    max(concept_cd) FILTER (role = 'LEAF') AS leaf_cd, max(concept_cd) FILTER (role = 'PLATFORM') AS platform_cd, max(concept_cd) FILTER (role = 'ATTR1') AS attr1_cd,
    max(concept_cd) FILTER (role = 'ATTR2') AS attr2_cd, max(concept_cd) FILTER (role = 'TISSUETYPE') AS tissuetype_cd
  FROM roles JOIN concepts USING (node_path) GROUP BY ALL)"""


def mapped(spark, sf):
    rows = samples(spark, sf)
    nodes = A.sample_nodes(rows, TOP)
    concepts = surrogate_ids(nodes.select(F.col("node_path").alias("concept_path")).distinct(), ["concept_path"], "concept_cd")
    keys = rows.select(T.subject_key(F.lit("ORD"), "site_id", "subject_id").alias("subject_key")).distinct()
    return A.sample_mapping(rows, surrogate_ids(keys, ["subject_key"], "patient_num"), concepts, "ORD", TOP)


@query(f"""WITH {MAPPING_SQL} SELECT m.*, patient_num, leaf_cd || '-' || patient_num AS data_uid FROM mapping m JOIN patients USING (subject_key)""")
def h04_sample_mapping(spark, sf):
    return mapped(spark, sf)


@query(f"""WITH {MAPPING_SQL}, rows AS (SELECT m.*, patient_num, leaf_cd || '-' || patient_num AS data_uid, CAST(substr(sample_cd, 2) AS BIGINT) AS k FROM mapping m JOIN patients USING (subject_key))
SELECT subject_key, sample_cd, platform, CASE WHEN k % 3 = 0 AND k % 5 = 0 THEN 'old' ELSE tissue_type END AS tissue_type, leaf_cd, patient_num, data_uid,
  CASE WHEN k % 3 = 0 AND k % 5 = 0 THEN 'kept' WHEN k % 5 = 0 THEN 'changed' WHEN k % 2 = 0 THEN 'identical' WHEN k % 3 = 0 THEN NULL ELSE 'new' END AS change FROM rows WHERE k % 3 <> 0 OR k % 5 = 0 OR k % 2 = 0""".replace("WHEN k % 2 = 0 THEN 'identical' WHEN k % 3 = 0 THEN NULL", "WHEN k % 2 = 0 AND k % 3 <> 0 THEN 'identical' WHEN k % 2 = 0 THEN 'kept'"))
def h04_mapping_reload(spark, sf):
    """Known samples (every second as it is, every fifth with an old tissue) meet a delivery without each third sample."""
    rows = mapped(spark, sf).select("subject_key", "sample_cd", "platform", "tissue_type", "leaf_cd", "patient_num", "data_uid")
    key = F.substring("sample_cd", 2, 20).cast("long")
    known = rows.where((key % 2 == 0) | (key % 5 == 0)).withColumn("tissue_type", F.when(key % 5 == 0, "old").otherwise(F.col("tissue_type")))
    return A.refresh_mapping(known, rows.where(key % 3 != 0))


@query("SELECT count(*) AS n_samples, count(*) AS n_mapped, true AS complete FROM orders")
def h04_all_loaded(spark, sf):
    return A.all_loaded(samples(spark, sf), mapped(spark, sf))


@query(f"WITH {SAMPLES_SQL} SELECT site_id, subject_id, sample_cd, platform FROM samples WHERE source_cd = 'STD' AND attribute_2 IS NOT NULL")
def h05_keep_delivered(spark, sf):
    rows = samples(spark, sf)
    old = rows.where("source_cd = 'STD'").select("site_id", "subject_id", "sample_cd", "platform")
    return A.keep_delivered(old, rows.where("attribute_2 is not null"), ["site_id", "subject_id", "sample_cd"])


@query(f"WITH {MAPPING_SQL} SELECT DISTINCT patient_num, leaf_cd AS concept_cd, 'ORD' AS study_id, 'T' AS value_type, 'E' AS text_value FROM mapping JOIN patients USING (subject_key)")
def h06_sample_facts(spark, sf):
    return A.sample_facts(mapped(spark, sf), "ORD")


@query(f"""WITH {ROLES_SQL}, k AS (SELECT node_path AS path, min(CASE WHEN role = 'LEAF' THEN 0 ELSE 1 END) AS k FROM roles GROUP BY 1)
SELECT path, CASE k WHEN 0 THEN 'LAH' ELSE 'FA' END AS attributes, 'T' AS data_type FROM k""")
def h07_node_types(spark, sf):
    nodes = A.sample_nodes(samples(spark, sf), TOP)
    tree = nodes.select(F.col("node_path").alias("path"), F.lit("LA").alias("attributes"), F.lit("N").alias("data_type")).distinct()
    return A.node_types(nodes, tree)


# --- values ----------------------------------------------------------------------

COLLAPSED_SQL = """
vals AS (SELECT l_partkey, l_suppkey, CAST(l_extendedprice - 2000 AS DECIMAL(18, 4)) AS v FROM lineitem),
collapsed AS (SELECT l_partkey, l_suppkey, CAST(sum(v) AS DOUBLE) / count(*) AS intensity FROM vals WHERE v > 0 GROUP BY ALL)"""

SCORED_SQL = COLLAPSED_SQL + """,
logs AS (SELECT *, log(intensity) / log(2) AS li FROM collapsed),
st AS (SELECT l_partkey, median(li) AS med, stddev_samp(li) AS sd FROM logs GROUP BY l_partkey),
scored AS (SELECT l.l_partkey, l_suppkey, round(intensity, 4) AS raw_intensity, round(li, 4) AS log_intensity,
  round(CASE WHEN sd = 0 THEN 0 ELSE greatest(least((li - med) / sd, 2.5), -2.5) END, 4) AS zscore FROM logs l JOIN st ON l.l_partkey = st.l_partkey)"""


def collapsed(spark, sf, **options):
    lines = t(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_extendedprice").withColumn("l_extendedprice", F.col("l_extendedprice") - 2000)
    return A.collapse_replicates(lines, ["l_partkey", "l_suppkey"], "l_extendedprice", **options)


def rounded(df, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in ("raw_intensity", "log_intensity", "zscore") if c in df.columns})


@query(f"WITH {COLLAPSED_SQL} SELECT * FROM collapsed")
def h08_replicate_collapse(spark, sf):
    return collapsed(spark, sf)


@query(f"""WITH {COLLAPSED_SQL} SELECT l_partkey, l_suppkey, round(intensity, 4) AS raw_intensity, round(log(intensity) / log(2), 4) AS log_intensity FROM collapsed""")
def h09_log_transform_raw(spark, sf):
    return rounded(A.log_transform(collapsed(spark, sf), "intensity", "R", 2)).drop("intensity")


@query("""SELECT event_id, round(pow(2, value / 100), 4) AS raw_intensity, round(value / 100, 4) AS log_intensity FROM events""")
def h09_log_transform_logged(spark, sf):
    rows = t(spark, sf, "events", "event_id", (F.col("value") / 100).alias("x"))
    return rounded(A.log_transform(rows, "x", "L", 2)).drop("x")


@query(f"WITH {SCORED_SQL} SELECT * FROM scored")
def h10_zscore(spark, sf):
    logged = A.log_transform(collapsed(spark, sf), "intensity").drop("intensity")
    return rounded(A.zscore(logged, ["l_partkey"]))


@query(f"""WITH vals AS (SELECT l_partkey, l_suppkey, l_discount * 100 - 5 AS v FROM lineitem)
SELECT l_partkey, l_suppkey, round(v, 4) AS v, round(greatest(least(v, 2.5), -2.5), 4) AS zscore FROM vals""")
def h11_clamp_only(spark, sf):
    from studyflow.functions.stats import clamp

    rows = t(spark, sf, "lineitem", "l_partkey", "l_suppkey", (F.col("l_discount") * 100 - 5).alias("v"))
    return rows.select("l_partkey", "l_suppkey", F.round("v", 4).alias("v"), F.round(clamp(F.col("v")), 4).alias("zscore"))


PROCESS_SQL = """
sm AS (SELECT s_name AS sample_cd, s_suppkey + 1000 AS assay_id, 'GPL' || (s_suppkey % 2) AS platform FROM supplier),
pr AS (SELECT 'GPL' || (p_size % 2) AS platform, CAST(p_partkey AS VARCHAR) AS probeset, p_partkey + 1 AS probeset_id FROM part),
vals AS (SELECT probeset_id, assay_id, CAST(l_extendedprice AS DECIMAL(18, 4)) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN sm ON s_name = sample_cd
  JOIN pr ON pr.probeset = CAST(l_partkey AS VARCHAR) AND pr.platform = sm.platform),
collapsed AS (SELECT probeset_id, assay_id, CAST(sum(v) AS DOUBLE) / count(*) AS x FROM vals {where} GROUP BY ALL)"""


def assay_inputs(spark, sf):
    lines = t(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_extendedprice")
    supplier = t(spark, sf, "supplier", "s_suppkey", "s_name")
    values = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").cast("string").alias("probeset"), F.col("s_name").alias("sample_cd"), F.col("l_extendedprice").alias("intensity")
    )
    sample_rows = supplier.select(F.col("s_name").alias("sample_cd"), (F.col("s_suppkey") + 1000).alias("assay_id"), F.concat(F.lit("GPL"), (F.col("s_suppkey") % 2).cast("string")).alias("platform"))
    probes = t(spark, sf, "part", "p_partkey", "p_size").select(
        F.concat(F.lit("GPL"), (F.col("p_size") % 2).cast("string")).alias("platform"), F.col("p_partkey").cast("string").alias("probeset"), (F.col("p_partkey") + 1).alias("probeset_id")
    )
    return sample_rows, values, probes


@query(f"""WITH {PROCESS_SQL.format(where='WHERE v > 0')}, logs AS (SELECT *, log(x) / log(2) AS li FROM collapsed),
st AS (SELECT probeset_id, median(li) AS med, stddev_samp(li) AS sd FROM logs GROUP BY 1)
SELECT l.probeset_id, assay_id, round(x, 4) AS raw_intensity, round(li, 4) AS log_intensity, round(CASE WHEN sd = 0 THEN 0 ELSE greatest(least((li - med) / sd, 2.5), -2.5) END, 4) AS zscore
FROM logs l JOIN st ON l.probeset_id = st.probeset_id""")
def h12_process_raw(spark, sf):
    return rounded(A.process(*assay_inputs(spark, sf), data_type="R"))


@query(f"""WITH {PROCESS_SQL.format(where='')} SELECT probeset_id, assay_id, CAST(NULL AS DOUBLE) AS raw_intensity, round(x, 4) AS log_intensity, CASE WHEN x > 2.5 THEN 2.5 ELSE round(x, 4) END AS zscore FROM collapsed""")
def h12_process_transformed(spark, sf):
    return rounded(A.process(*assay_inputs(spark, sf), data_type="T"))


@query("""SELECT CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'R1' ELSE split_part(p_name, ' ', 1) END AS sample_cd, p_type AS probeset, CAST(p_size AS DOUBLE) AS intensity, p_brand AS uniprot_id
FROM part WHERE p_size % 3 <> 0""")
def h12_panel_load(spark, sf):
    part = t(spark, sf, "part", "p_name", "p_type", "p_size", "p_brand")
    landing = part.select("p_name", F.col("p_type").alias("probeset"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string")).otherwise("n/a").alias("intensity"), F.col("p_brand").alias("uniprot_id"))
    names = spark.createDataFrame([("red", "R1")], "name string, code string")
    return numeric_only(strip_and_map_samples(landing, "p_name", " .*$", names, "name", "code"), "intensity").select("sample_cd", "probeset", "intensity", "uniprot_id")


@query(f"""WITH {SAMPLES_SQL} SELECT 'loaded' AS outcome, 'ORD' AS study_id, sample_cd, coalesce(attribute_1, 'Unknown') AS tissue_type FROM samples WHERE coalesce(source_cd, 'STD') = 'STD' AND attribute_2 IS NOT NULL
UNION ALL SELECT 'reject', 'ORD', sample_cd, coalesce(attribute_1, 'Unknown') FROM samples WHERE coalesce(source_cd, 'STD') = 'STD' AND attribute_2 IS NULL
UNION ALL SELECT 'skipped', study_id, sample_cd, attribute_1 FROM samples WHERE source_cd <> 'STD'""")
def h13_load_sample_map(spark, sf):
    rows = samples(spark, sf).withColumn("tissue_type", F.col("attribute_1"))
    good, bad, skipped = A.load_sample_map(rows, "STD", ["subject_id", "sample_cd", "attribute_2"])
    return good.withColumn("outcome", F.lit("loaded")).unionByName(bad.withColumn("outcome", F.lit("reject"))).unionByName(skipped.withColumn("outcome", F.lit("skipped"))).select("outcome", "study_id", "sample_cd", "tissue_type")


@query(f"WITH {SCORED_SQL} SELECT * EXCLUDE (raw_intensity) FROM scored")
def h45_incremental_matrix(spark, sf):
    logged = staged(A.log_transform(collapsed(spark, sf), "intensity").drop("intensity"), "logged")
    existing = staged(A.zscore(logged.where("l_suppkey % 3 <> 0"), ["l_partkey"]), "matrix")
    return rounded(A.append_samples(existing, logged, ["l_partkey", "l_suppkey"], ["l_partkey"])).drop("raw_intensity")


# --- annotation --------------------------------------------------------------------

LAND_SQL = """
land AS (SELECT 'GPL' || (p_size % 3) AS platform, 'P' || p_partkey AS probeset, p_name AS gene_symbol, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS gene_id,
  CASE WHEN p_size % 5 <> 0 THEN p_type END AS organism FROM part),
old AS (SELECT CAST(row_number() OVER (ORDER BY substr(md5(platform || chr(1) || probeset), 1, 3), platform, probeset) AS BIGINT) AS probeset_id, platform, probeset, 'old' AS organism FROM land WHERE platform = 'GPL1'),
probes AS (SELECT o.probeset_id, o.platform, o.probeset, coalesce(l.organism, o.organism) AS organism FROM old o JOIN land l USING (platform, probeset)
  UNION ALL SELECT (SELECT max(probeset_id) FROM old) + row_number() OVER (ORDER BY substr(md5(platform || chr(1) || probeset), 1, 3), platform, probeset), platform, probeset, coalesce(organism, 'Homo sapiens') FROM land WHERE platform <> 'GPL1')"""


def landing(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_size")
    return part.select(
        F.concat(F.lit("GPL"), (F.col("p_size") % 3).cast("string")).alias("platform"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("probeset"),
        F.col("p_name").alias("gene_symbol"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_size")).alias("gene_id"), F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("organism"),
    )


def probe_table(spark, sf):
    land = landing(spark, sf)
    old = surrogate_ids(land.where("platform = 'GPL1'").select("platform", "probeset"), ["platform", "probeset"], "probeset_id").withColumn("organism", F.lit("old"))
    return AN.upsert_probes(old, land)


@query(f"WITH {LAND_SQL} SELECT * FROM probes")
def h14_upsert_probes(spark, sf):
    return probe_table(spark, sf)


@query(f"""WITH {LAND_SQL} SELECT DISTINCT l.platform, l.probeset, gene_symbol, gene_id, probeset_id, p.organism FROM land l JOIN probes p ON l.platform = p.platform AND l.probeset = p.probeset
  AND coalesce(l.organism, 'Homo sapiens') = p.organism""")
def h14_annotate(spark, sf):
    return AN.annotate(landing(spark, sf), probe_table(spark, sf))


@query("""WITH ann AS (SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS gene_symbol, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS gene_id, lower(p_type) AS organism FROM part),
markers AS (SELECT DISTINCT p_brand AS symbol, p_size AS gene_id, p_type AS organism FROM part WHERE p_size % 2 = 0),
by_symbol AS (SELECT symbol, upper(organism) AS o, min(gene_id) AS id FROM markers GROUP BY ALL), by_id AS (SELECT gene_id, upper(organism) AS o, min(symbol) AS s FROM markers GROUP BY ALL),
one AS (SELECT p_partkey, gene_symbol, coalesce(gene_id, id) AS gene_id, organism FROM ann LEFT JOIN by_symbol ON gene_symbol = symbol AND upper(organism) = o)
SELECT p_partkey, coalesce(gene_symbol, s) AS gene_symbol, one.gene_id, organism FROM one LEFT JOIN by_id ON one.gene_id = by_id.gene_id AND upper(organism) = o""")
def h15_fill_genes(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_brand", "p_size", "p_type")
    ann = part.select(
        "p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("gene_symbol"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_size")).alias("gene_id"), F.lower("p_type").alias("organism")
    )
    markers = part.where("p_size % 2 = 0").select(F.col("p_brand").alias("symbol"), F.col("p_size").alias("gene_id"), F.col("p_type").alias("organism")).distinct()
    return AN.fill_genes(ann, markers)


@query("""SELECT s_name AS platform, CASE WHEN s_suppkey % 3 = 0 THEN 'old' ELSE 'title ' || s_nationkey END AS title, CASE WHEN s_suppkey % 3 = 0 THEN 'SNP' ELSE 'Gene Expression' END AS marker_type,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Mus musculus' ELSE 'Homo sapiens' END AS organism FROM supplier""")
def h16_platform_catalogue(spark, sf):
    supplier = t(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    old = supplier.where("s_suppkey % 2 = 0 or s_suppkey % 3 = 0").select(F.col("s_name").alias("platform"), F.lit("old").alias("title"), F.lit("SNP").alias("marker_type"), F.lit("Mus musculus").alias("organism"))
    new = supplier.where("s_suppkey % 3 <> 0").select(
        F.col("s_name").alias("platform"), F.concat(F.lit("title "), F.col("s_nationkey").cast("string")).alias("title"), F.lit("Gene Expression").alias("marker_type"), F.lit("Homo sapiens").alias("organism")
    )
    return AN.platform_catalogue(old, new)


@query("""SELECT p_partkey, CAST(pos AS INTEGER) AS pos, word AS symbol, CASE pos WHEN 1 THEN CAST(p_size AS VARCHAR) END AS gene_id FROM (
  SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part)""")
def h17_nested_gene_table(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_size")
    rows = part.select("p_partkey", F.concat(F.lit("x // "), F.replace("p_name", F.lit(" "), F.lit(" // y /// x // "))).alias("genes"), F.col("p_size").cast("string").alias("ids"))
    symbols = AN.nested_genes(rows, "genes", ["p_partkey"], ["accession", "symbol"]).select("p_partkey", "pos", "symbol")
    ids = AN.nested_genes(rows, "ids", ["p_partkey"], ["gene_id"])
    return AN.zip_by_position(ids, symbols, ["p_partkey"])


@query("""SELECT 'GPL' || p_partkey % 2 AS platform, 'P' || p_partkey AS probe, p_brand AS gene_symbol, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS gene_id, CASE WHEN p_partkey % 2 = 1 THEN p_type END AS organism FROM part""")
def h17_columns_by_number(spark, sf):
    """Two platforms whose files place their columns differently, in one scan."""
    part = t(spark, sf, "part", "p_partkey", "p_brand", "p_type", F.col("p_size").cast("string").alias("size"))
    probe = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws("\t", probe, "size", F.lit("x"), "p_brand")).otherwise(F.concat_ws("\t", "p_type", "p_brand", probe))
    lines = part.select(F.concat(F.lit("GPL"), (F.col("p_partkey") % 2).cast("string")).alias("platform"), F.explode(F.array(F.lit("# note"), line)).alias("line"))
    places = spark.createDataFrame([("GPL0", "probe", 1), ("GPL0", "gene_id", 2), ("GPL0", "gene_symbol", 4), ("GPL1", "organism", 1), ("GPL1", "gene_symbol", 2), ("GPL1", "probe", 3), ("GPL7", "probe", 1)], "platform string, field string, column_number int")
    return AN.by_number(lines, places, ["probe", "gene_symbol", "gene_id", "organism"])


@query("""SELECT 'GPL9' AS platform, p_name AS probeset, p_brand AS gene_symbol, CAST(p_size AS VARCHAR) AS gene_id, CASE WHEN p_size % 4 = 0 THEN 'Homo sapiens' ELSE p_type END AS organism FROM part WHERE p_size % 3 <> 0""")
def h18_annotation_by_header(spark, sf):
    part = t(spark, sf, "part", "p_name", "p_brand", "p_size", "p_type").select(
        F.col("p_name").alias("ID"), F.col("p_brand").alias("Gene Symbol"), F.when(F.col("p_size") % 3 == 0, "n/a").otherwise(F.col("p_size").cast("string")).alias("ENTREZ_GENE_ID"),
        F.when(F.col("p_size") % 4 == 0, " ").otherwise(F.col("p_type")).alias("Species Scientific Name"),
    )
    return AN.by_header(part, "ID", AN.header_columns(part.columns), "GPL9")


@query("""SELECT p_partkey, p_brand AS symbol, p_type AS title, CAST(p_size AS VARCHAR) AS gene_id, 'result' AS outcome FROM part WHERE p_size % 6 <> 0
UNION SELECT p_partkey, p_name, p_type, '7', 'result' FROM part WHERE p_size % 6 <> 0 UNION ALL SELECT p_partkey, NULL, NULL, NULL, 'reject' FROM part WHERE p_size % 6 = 0""")
def h19_gene_assignments(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    entry = F.concat_ws(" // ", F.lit("NM_1"), "p_brand", "p_type", F.lit("1q2"), F.col("p_size").cast("string"))
    other = F.concat_ws(" // ", F.lit("NM_2"), "p_name", "p_type", F.lit("1q3"), F.lit("7"))
    rows = part.select("p_partkey", F.when(F.col("p_size") % 6 == 0, "---").otherwise(F.concat_ws(" /// ", entry, other, entry)).alias("assignment"))
    result, reject = AN.gene_assignments(rows, "assignment", ["p_partkey"])
    none = F.lit(None).cast("string")
    return result.withColumn("outcome", F.lit("result")).unionByName(
        reject.select("p_partkey", none.alias("symbol"), none.alias("title"), none.alias("gene_id"), F.lit("reject").alias("outcome"))
    )


SNP_ROWS_SQL = """s AS (SELECT CASE WHEN p_size % 8 = 0 THEN 'AFFX-' || p_partkey ELSE 'SNP_A-' || p_partkey END AS probe, 'rs' || p_partkey AS rs, CASE WHEN p_size % 5 = 0 THEN '---' ELSE CAST(p_size AS VARCHAR) END AS chrom,
  p_partkey * 10 AS pos, p_brand, p_name FROM part)"""


def snp_rows(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_size")
    return part.select(
        F.concat(F.when(F.col("p_size") % 8 == 0, "AFFX-").otherwise("SNP_A-"), F.col("p_partkey").cast("string")).alias("probe"), F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("rs"),
        F.when(F.col("p_size") % 5 == 0, "---").otherwise(F.col("p_size").cast("string")).alias("chrom"), (F.col("p_partkey") * 10).cast("string").alias("pos"),
        F.concat_ws(" /// ", F.concat_ws(" // ", F.lit("NM"), F.lit("intron"), F.lit("0"), F.lit("p"), "p_brand"), F.concat_ws(" // ", F.lit("NM"), F.lit("exon"), F.lit("0"), F.lit("q"), "p_name")).alias("genes"),
    )


@query(f"""WITH {SNP_ROWS_SQL}, ok AS (SELECT * FROM s WHERE probe NOT LIKE 'AFFX%' AND chrom <> '---')
SELECT o.probe AS snp_id, rs AS rs_id, chrom, CAST(pos AS BIGINT) AS position, g.symbol FROM ok o JOIN (SELECT probe, p_brand AS symbol FROM ok UNION SELECT probe, p_name FROM ok) g ON o.probe = g.probe""")
def h20_snp_annotation(spark, sf):
    snps, links = AN.snp_annotation(snp_rows(spark, sf), "probe", "rs", "chrom", "pos", "genes")
    return snps.join(links, "snp_id")


PLATFORM_SQL = """
f AS (SELECT CASE WHEN p_size % 8 = 0 THEN 'AFFX-' || p_partkey ELSE 'SNP_A-' || p_partkey END AS probe, CASE WHEN p_size % 7 = 0 THEN '---' ELSE 'rs' || p_partkey END AS rs_id,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS chrom, CAST(p_partkey * 10 AS VARCHAR) AS position, p_brand, p_name, p_size FROM part)"""


def platform_lines(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_size")
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")

    def gene(symbol, gene_id):
        return F.concat_ws(" // ", F.lit("NM"), F.lit("intron"), F.lit("0"), F.lit("x"), symbol, gene_id, F.lit("title"))

    genes = F.concat_ws(" /// ", gene(F.col("p_brand"), size.cast("string")), gene(F.col("p_name"), F.when(size % 3 == 0, "---").otherwise("77")))
    blank = F.lit("")
    return part.select(F.concat_ws(
        "\t", F.concat(F.when(size % 8 == 0, "AFFX-").otherwise("SNP_A-"), key), F.when(size % 7 == 0, "---").otherwise(F.concat(F.lit("rs"), key)),
        F.when(size % 5 == 0, "").otherwise(size.cast("string")), blank, blank, (F.col("p_partkey") * 10).cast("string"), *[blank] * 6, genes, blank, blank
    ).alias("line"))


@query(f"WITH {PLATFORM_SQL} SELECT probe, rs_id, chrom, position FROM f WHERE probe NOT LIKE 'AFFX%' AND chrom <> '' AND rs_id <> '---'")
def h21_platform_probes(spark, sf):
    return AN.platform_probes(platform_lines(spark, sf), AN.PLATFORM_LAYOUTS["GPL2004"])[0]


@query(f"WITH {PLATFORM_SQL} SELECT probe, CAST(p_size AS VARCHAR) AS gene_id, p_brand AS symbol FROM f UNION SELECT probe, '77', p_name FROM f WHERE p_size % 3 <> 0")
def h21_platform_genes(spark, sf):
    return AN.platform_probes(platform_lines(spark, sf), AN.PLATFORM_LAYOUTS["GPL2004"])[1]


@query(f"WITH {PLATFORM_SQL} SELECT chrom, probe, 0 AS distance, position FROM f WHERE probe NOT LIKE 'AFFX%' AND chrom <> ''")
def h21_platform_map(spark, sf):
    return AN.platform_probes(platform_lines(spark, sf), AN.PLATFORM_LAYOUTS["GPL2004"])[2]


@query("""SELECT 'loaded' AS outcome, 'GPL7' AS platform, p_name AS peptide, p_brand AS uniprot_id, CASE WHEN p_size % 2 = 0 THEN 'Homo sapiens' ELSE p_type END AS organism FROM part WHERE p_size % 9 <> 0
UNION ALL SELECT 'reject', 'GPL7', NULL, p_brand, CASE WHEN p_size % 2 = 0 THEN 'Homo sapiens' ELSE p_type END FROM part WHERE p_size % 9 = 0""")
def h47_assay_annotation(spark, sf):
    part = t(spark, sf, "part", "p_name", "p_brand", "p_size", "p_type").select(
        F.when(F.col("p_size") % 9 != 0, F.col("p_name")).otherwise(" ").alias("peptide"), F.col("p_brand").alias("uniprot_id"), F.when(F.col("p_size") % 2 != 0, F.col("p_type")).alias("organism")
    )
    good, bad = AN.assay_landing(part, "proteomics", "GPL7")
    return good.withColumn("outcome", F.lit("loaded")).unionByName(bad.withColumn("outcome", F.lit("reject")))
