r"""Queries of the concept-tree operators on ``\region\nation\segment\`` paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.functions import paths as P
from studyflow.operators import merge as M
from studyflow.operators import tree as TR
from studyflow.operators.numbering import surrogate_ids
from studyflow.plans.data import FULL_TREE_SQL, PATHS_SQL, TREE_SQL, customer_paths, region_tree, t
from studyflow.plans.registry import query

COUNTS_SQL = PATHS_SQL + r""",
counts AS (
  SELECT path, count(DISTINCT patient_num) AS patient_count, parent_path FROM (
    SELECT path, patient_num, '\' || r_name || '\' || n_name || '\' AS parent_path FROM paths
    UNION ALL SELECT '\' || r_name || '\' || n_name || '\', patient_num, '\' || r_name || '\' FROM paths
    UNION ALL SELECT '\' || r_name || '\', patient_num, NULL FROM paths) GROUP BY path, parent_path)"""


@query(f"WITH {PATHS_SQL} SELECT patient_num, string_split(path, '\\')[1] AS p1, string_split(path, '\\')[3] AS p3, string_split(path, '\\')[9] AS p9 FROM paths")
def d01_nth_part(spark, sf):
    return customer_paths(spark, sf).select("patient_num", *[P.nth("path", n).alias(f"p{n}") for n in (1, 3, 9)])


@query(rf"""WITH {PATHS_SQL}, pos AS (SELECT patient_num, len(path) AS n, list_filter(range(1, len(path) + 1), lambda i: path[i] = '\') AS hits FROM paths)
SELECT patient_num, CAST(hits[1] AS INTEGER) AS first_sep, CAST(hits[2] AS INTEGER) AS second_sep, CAST(hits[-1] AS INTEGER) AS last_sep,
  CAST(hits[-2] AS INTEGER) AS before_last, CAST(coalesce(hits[9], 0) AS INTEGER) AS ninth,
  CAST(list_filter(hits, lambda i: i <= n - 1)[-1] AS INTEGER) AS from_second_last FROM pos""")
def d02_instr(spark, sf):
    return customer_paths(spark, sf).select(
        "patient_num", P.instr("path", "\\").alias("first_sep"), P.instr("path", "\\", 1, 2).alias("second_sep"),
        P.instr("path", "\\", -1).alias("last_sep"), P.instr("path", "\\", -1, 2).alias("before_last"),
        P.instr("path", "\\", 1, 9).alias("ninth"), P.instr("path", "\\", -2).alias("from_second_last"),
    )


@query(f"WITH {TREE_SQL} SELECT path, CAST(level + 1 AS INTEGER) AS level, name FROM tree")
def d03_level_and_name(spark, sf):
    nodes = TR.fill_ancestors(customer_paths(spark, sf).select("path").distinct())
    return TR.node_rows(nodes, root_level=1).select("path", "level", "name")


@query(f"WITH {TREE_SQL} SELECT path FROM tree")
def d04_fill_ancestors(spark, sf):
    return TR.fill_ancestors(customer_paths(spark, sf).select("path").distinct())


@query(rf"WITH {PATHS_SQL} SELECT DISTINCT '\' || r_name || '\' AS path FROM paths")
def d04_missing_ancestors(spark, sf):
    paths = customer_paths(spark, sf)
    have = paths.select("path").union(paths.select(P.build("r_name", "n_name"))).distinct()
    return TR.missing_ancestors(have)


@query(rf"""WITH {TREE_SQL} SELECT path, CAST(level AS INTEGER) AS level, name,
  CASE WHEN level = 0 THEN 'CA' ELSE 'FA' END AS attributes FROM tree
UNION ALL SELECT DISTINCT '\' || p_type || '\', 0, p_type, 'CA' FROM part
UNION ALL SELECT DISTINCT '\' || p_type || '\' || p_brand || '\', 1, p_brand, 'FA' FROM part""")
def d05_add_nodes(spark, sf):
    tree = region_tree(spark, sf).select("path", "level", "name", F.when(F.col("level") == 0, "CA").otherwise("FA").alias("attributes"))
    part = t(spark, sf, "part", "p_type", "p_brand")
    new = TR.fill_ancestors(part.select(P.build("p_type", "p_brand").alias("path")).distinct())
    return TR.add_nodes(tree, new)


@query(rf"""WITH {PATHS_SQL}, old AS (
  SELECT CAST(n_nationkey AS BIGINT) + 1 AS concept_cd, '\' || n_name || '\' AS concept_path, 'old ' || n_name AS name FROM nation WHERE n_regionkey <> 2),
new AS (SELECT DISTINCT '\' || n_name || '\' AS concept_path, n_name AS name FROM paths),
fresh AS (SELECT * FROM new WHERE concept_path NOT IN (SELECT concept_path FROM old))
SELECT o.concept_cd, o.concept_path, coalesce(n.name, o.name) AS name FROM old o LEFT JOIN new n USING (concept_path)
UNION ALL SELECT row_number() OVER (ORDER BY substr(md5(concept_path), 1, 3), concept_path) + (SELECT max(concept_cd) FROM old), concept_path, name FROM fresh""")
def d06_upsert_concepts(spark, sf):
    nation = t(spark, sf, "nation")
    old = nation.where("n_regionkey <> 2").select(
        (F.col("n_nationkey").cast("long") + 1).alias("concept_cd"), P.build("n_name").alias("concept_path"), F.concat(F.lit("old "), "n_name").alias("name")
    )
    leaves = customer_paths(spark, sf).select(P.build("n_name").alias("concept_path"), F.col("n_name").alias("name")).distinct()
    return TR.upsert_concepts(old, leaves)


@query(f"WITH {COUNTS_SQL} SELECT * FROM counts")
def d07_patient_counts(spark, sf):
    return TR.counts(customer_paths(spark, sf))


@query(rf"""WITH {PATHS_SQL}, src AS (SELECT path, n_name || CASE WHEN patient_num % 3 = 0 THEN ':S:' ELSE ':' END || patient_num AS subject_key FROM paths)
SELECT p AS path, count(DISTINCT subject_key) AS patient_count FROM (SELECT subject_key, unnest(['\' || split_part(path, '\', 2) || '\', '\' || split_part(path, '\', 2) || '\' || split_part(path, '\', 3) || '\', path]) AS p FROM src)
WHERE subject_key NOT LIKE '%:S:%' GROUP BY p""")
def d07_counts_without_samples(spark, sf):
    rows = customer_paths(spark, sf).withColumn(
        "subject_key", F.concat("n_name", F.when(F.col("patient_num") % 3 == 0, ":S:").otherwise(":"), F.col("patient_num").cast("string"))
    )
    counted = TR.counts(TR.without_sample_subjects(rows), "path", "subject_key")
    return counted.select("path", "patient_count")


@query(rf"""WITH {FULL_TREE_SQL},
pos AS (SELECT DISTINCT r_name, n_name FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE o_orderpriority = '1-URGENT')
SELECT path, name, CASE WHEN path IN (SELECT '\' || r_name || '\' FROM pos UNION SELECT '\' || r_name || '\' || n_name || '\' FROM pos)
  THEN attributes ELSE substr(attributes, 1, 1) || 'H' END AS attributes FROM full_tree""")
def d08_hide_uncounted(spark, sf):
    urgent = t(spark, sf, "orders", "o_custkey", "o_orderpriority").where("o_orderpriority = '1-URGENT'")
    paths = customer_paths(spark, sf).join(urgent, F.col("patient_num") == F.col("o_custkey"), "left_semi")
    counted = TR.counts(paths.select(P.build("r_name", "n_name").alias("path"), "patient_num"))
    return TR.hide_uncounted(region_tree(spark, sf), counted).select("path", "name", "attributes")


@query(rf"WITH {TREE_SQL} SELECT path, name FROM tree WHERE NOT (level = 1 AND name LIKE '%1')")
def d09_delete_nodes(spark, sf):
    tree = region_tree(spark, sf)
    return TR.delete(tree, tree.where("level = 1 and name like '%1'").select("path")).select("path", "name")


@query(rf"WITH {TREE_SQL} SELECT path, name FROM tree WHERE NOT (level >= 1 AND string_split(path, '\')[3] LIKE '%1')")
def d09_delete_subtrees(spark, sf):
    tree = region_tree(spark, sf)
    return TR.delete(tree, tree.where("level = 1 and name like '%1'").select("path"), subtree=True).select("path", "name")


@query(rf"""WITH {PATHS_SQL} SELECT 'facts' AS table_name, count(*) AS n_rows FROM paths WHERE n_name NOT LIKE '%1'
UNION ALL SELECT 'nation', count(*) FROM nation WHERE n_name NOT LIKE '%1'""")
def d09_cascade(spark, sf):
    nation = t(spark, sf, "nation")
    doomed = nation.where("n_name like '%1'").select("n_name")
    left = M.cascade({"facts": (customer_paths(spark, sf), "n_name"), "nation": (nation, "n_name")}, doomed, "n_name")
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("table_name"), "n_rows") for k, df in left.items()]
    return counted[0].unionByName(counted[1])


@query(rf"""WITH {FULL_TREE_SQL} SELECT path FROM full_tree WHERE attributes LIKE 'L%' AND path LIKE '\ASIA\%'
  AND path NOT IN (SELECT path FROM paths WHERE n_name LIKE '%2') AND path NOT IN (SELECT path FROM paths WHERE path LIKE '%MACHINERY%')""")
def d10_unused_leaves(spark, sf):
    paths = customer_paths(spark, sf)
    return TR.unused_leaves(
        region_tree(spark, sf), "\\ASIA\\", paths.where("n_name like '%2'"), paths.where(F.contains("path", F.lit("MACHINERY")))
    )


@query(rf"""WITH {FULL_TREE_SQL}, n AS (SELECT p.path, count(*) AS n FROM full_tree p JOIN full_tree c ON starts_with(c.path, p.path) GROUP BY p.path)
SELECT f.path, CASE WHEN NOT starts_with(f.path, '\ASIA\') THEN attributes WHEN n = 1 THEN 'L' || substr(attributes, 2, 2)
  WHEN f.path = '\ASIA\' THEN 'F' || substr(attributes, 2, 1) || 'J' ELSE 'F' || substr(attributes, 2, 1) || substr(attributes, 3, 1) END AS attributes,
  data_type FROM full_tree f JOIN n ON f.path = n.path""")
def d11_leaf_flags(spark, sf):
    tree = region_tree(spark, sf)
    return TR.set_leaf_flags(tree, "\\ASIA\\", highlight=True).select("path", "attributes", "data_type")


@query(rf"""WITH {FULL_TREE_SQL}, s AS (SELECT path, name, 'ORD' AS source FROM full_tree)
SELECT path, CASE WHEN len(path) < len('\ASIA\NATION_1\') THEN NULL ELSE source END AS source FROM s""")
def d12_clear_source(spark, sf):
    tree = region_tree(spark, sf).withColumn("source", F.lit("ORD"))
    return TR.clear_source_above(tree, "ORD", "\\ASIA\\NATION_1\\").select("path", "source")


@query(rf"""WITH {TREE_SQL} SELECT CASE WHEN starts_with(path, '\ASIA\') THEN '\Archive\Old\' || substr(path, len('\ASIA\') + 1) ELSE path END AS path,
  CAST(CASE WHEN starts_with(path, '\ASIA\') THEN level + 1 ELSE level END AS INTEGER) AS level, name FROM tree""")
def d13_move_subtree(spark, sf):
    return TR.move(region_tree(spark, sf).select("path", "level", "name"), "\\ASIA\\", "\\Archive\\Old\\")


@query(rf"""WITH {TREE_SQL} SELECT CASE WHEN string_split(path, '\')[2] = 'EUROPE' THEN replace(path, '\EUROPE\', '\Europe North\') ELSE path END AS path,
  CASE WHEN string_split(path, '\')[2] = 'EUROPE' AND name = 'EUROPE' THEN 'Europe North' ELSE name END AS name FROM tree""")
def d14_rename_node(spark, sf):
    tree = region_tree(spark, sf).select("path", "name")
    return TR.rename(tree, "EUROPE", "Europe North", P.nth("path", 2) == "EUROPE", ["path"])


@query(rf"""WITH {FULL_TREE_SQL} SELECT path, CASE WHEN starts_with(path, '\ASIA\') THEN substr(attributes, 1, 1) || 'H' ELSE attributes END AS hidden,
  attributes AS shown FROM full_tree""")
def d15_hide_and_unhide(spark, sf):
    tree = TR.set_visible(region_tree(spark, sf), "\\ASIA\\", False)
    both = tree.withColumnRenamed("attributes", "hidden").withColumn("attributes", F.col("hidden"))
    return TR.set_visible(both, "\\ASIA\\", True).select("path", "hidden", F.col("attributes").alias("shown"))


@query(f"""WITH {PATHS_SQL} SELECT patient_num, 'SECURITY' AS concept_cd, n_name AS study_id,
  CASE WHEN r_name = 'ASIA' THEN 'EXP:' || n_name ELSE 'EXP:PUBLIC' END AS token FROM paths""")
def d16_security_rows(spark, sf):
    return TR.security_rows(customer_paths(spark, sf), F.col("n_name"), F.col("r_name") == "ASIA")


@query(rf"""WITH {FULL_TREE_SQL} SELECT path, name, CASE WHEN source IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
  THEN 'EXP:' || source ELSE 'EXP:PUBLIC' END AS token FROM full_tree""")
def d17_secured_tree(spark, sf):
    tokens = TR.security_rows(customer_paths(spark, sf), F.col("n_name"), F.col("r_name") == "ASIA")
    return TR.secured(region_tree(spark, sf), tokens).select("path", "name", "token")


@query(rf"""WITH {FULL_TREE_SQL} SELECT source, string_split(path, '\')[2] || ' - ' || name AS display_name, 'EXP:' || source AS object_id
FROM full_tree WHERE level = 1 AND source NOT IN (SELECT n_name FROM nation WHERE n_regionkey = 1)""")
def d18_secure_objects(spark, sf):
    registered = t(spark, sf, "nation").where("n_regionkey = 1").select(F.concat(F.lit("EXP:"), "n_name").alias("object_id"))
    return TR.secure_objects(region_tree(spark, sf), registered)


@query("""SELECT 'EXP:' || n_name AS object_id, r_name || ' - ' || n_name AS display_name, n_name AS accession, CASE r_regionkey WHEN 0 THEN 'known' ELSE 'Metadata not available' END AS title
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey IN (0, 2) AND n_nationkey IN (SELECT c_nationkey FROM customer)
UNION ALL SELECT 'EXP:' || n_name, 'before', n_name, 'known' FROM nation WHERE n_regionkey = 3""")
def d18_security_registration(spark, sf):
    """Two regions' studies become secured (one without experiments), one region is opened, another's objects stay."""
    nation = t(spark, sf, "nation", "n_name", "n_regionkey")
    registered = nation.where("n_regionkey in (1, 3)").select(F.concat(F.lit("EXP:"), "n_name").alias("object_id"), F.lit("before").alias("display_name"), F.col("n_name"))
    known = surrogate_ids(nation.where("n_regionkey in (0, 1, 3)").select(F.col("n_name").alias("accession")), ["accession"], "experiment_id").withColumn("title", F.lit("known"))
    objects = registered.join(known, F.col("n_name") == F.col("accession")).select("object_id", "display_name", "experiment_id")
    studies = nation.where("n_regionkey in (0, 1, 2)").select(F.col("n_name").alias("source"), (F.col("n_regionkey") != 1).alias("secured"))
    after, experiments = TR.register_security(region_tree(spark, sf), studies, objects, known)
    return after.join(experiments, "experiment_id").drop("experiment_id")


@query("""SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def d19_study_backout(spark, sf):
    orders = t(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    lines = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    doomed = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    left = M.cascade({"orders": (orders, "o_orderkey"), "lineitem": (lines, "l_orderkey")}, doomed, "k")
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("table_name"), "n_rows") for k, df in left.items()]
    return counted[0].unionByName(counted[1])


@query(r"""SELECT '\Biomarker\' || coalesce(o_orderpriority || '\', '') || coalesce(o_orderstatus || '\', '') AS path, count(o_orderkey) AS patient_count
FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def d20_counts_by_level(spark, sf):
    orders = t(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    return TR.counts_by_level(orders, "\\Biomarker\\", ["o_orderpriority", "o_orderstatus"], "o_orderkey")


@query(rf"""WITH {FULL_TREE_SQL} SELECT min(path) AS path, 'SEGMENT' AS tag_type, c_mktsegment AS tag
FROM (SELECT DISTINCT n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey) l JOIN full_tree ON source = n_name GROUP BY c_mktsegment""")
def d21_tags(spark, sf):
    customer = t(spark, sf, "customer", "c_nationkey", "c_mktsegment").distinct()
    nation = t(spark, sf, "nation", "n_nationkey", "n_name")
    links = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("source"), "c_mktsegment")
    return TR.tags(links, region_tree(spark, sf), "SEGMENT", "c_mktsegment")


@query(r"""WITH s AS (SELECT p_type, p_brand, p_size, p_partkey FROM part), r AS (
  SELECT p_type, p_brand, p_size, count(DISTINCT p_partkey) AS n FROM s GROUP BY ROLLUP (p_type, p_brand, p_size))
SELECT '\Assay\Parts\' || coalesce(p_type || '\', '') || coalesce(p_brand || '\', '') || coalesce(p_size || '\', '') AS path,
  CAST(1 + (p_type IS NOT NULL)::INT + (p_brand IS NOT NULL)::INT + (p_size IS NOT NULL)::INT AS INTEGER) AS level,
  coalesce(CAST(p_size AS VARCHAR), p_brand, p_type, 'Parts') AS name, CASE WHEN p_size IS NULL THEN 'FA' ELSE 'LA' END AS attributes, n AS n_samples FROM r""")
def d22_assay_tree(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_type", "p_brand", "p_size").select(
        "p_type", "p_brand", F.col("p_size").cast("string").alias("p_size"), F.col("p_partkey").alias("sample_id")
    )
    return TR.assay_tree(part, "\\Assay\\Parts\\", ["p_type", "p_brand", "p_size"])
