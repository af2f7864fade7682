"""Inputs of the demonstration queries, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.sources.tables import read_table, spread


def t(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf, name, *columns)  # columns may be expressions


def money(c):
    """Two-decimal text of an amount."""
    return c.cast("decimal(18,2)").cast("string")


def customer_paths(spark: SparkSession, sf: str) -> DataFrame:
    r"""``\region\nation\segment\`` of every customer."""
    from studyflow.functions import paths as P

    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    nation = t(spark, sf, "nation")
    region = t(spark, sf, "region")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(P.build("r_name", "n_name", "c_mktsegment").alias("path"), F.col("c_custkey").alias("patient_num"), "n_name", "r_name")


PATHS_SQL = r"""
paths AS (
  SELECT '\' || r_name || '\' || n_name || '\' || c_mktsegment || '\' AS path, c_custkey AS patient_num, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

TREE_SQL = PATHS_SQL + r""",
tree AS (
  SELECT path, len(path) - len(replace(path, '\', '')) - 2 AS level, string_split(path, '\')[-2] AS name FROM (
    SELECT path FROM paths
    UNION SELECT '\' || r_name || '\' || n_name || '\' FROM paths
    UNION SELECT '\' || r_name || '\' FROM paths))"""


def region_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The region / nation / segment tree with level, name, attributes, type and source study (its nation)."""
    from studyflow.functions import paths as P
    from studyflow.operators import tree as TR

    nodes = TR.node_rows(TR.fill_ancestors(customer_paths(spark, sf).select("path").distinct()))
    return nodes.select(
        "path", "level", "name", F.when(F.col("level") == 2, "LA").otherwise("FA").alias("attributes"),
        F.lit("T").alias("data_type"), P.nth("path", 3).alias("source"),
    ).withColumn("source", F.nullif("source", F.lit("")))


FULL_TREE_SQL = TREE_SQL + r""",
full_tree AS (
  SELECT path, level, name, CASE WHEN level = 2 THEN 'LA' ELSE 'FA' END AS attributes, 'T' AS data_type,
         nullif(string_split(path, '\')[3], '') AS source FROM tree)"""


def landing(spark: SparkSession, sf: str) -> DataFrame:
    """Clinical landing rows: five readings per order of a customer."""
    orders = spread(t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), "o_orderkey")
    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    nation = t(spark, sf, "nation", "n_nationkey", "n_name")
    base = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    visit = F.concat(F.lit("Visit "), F.year("o_orderdate").cast("string"))

    def reading(category, label, value, visit_name):
        return F.struct(
            F.lit(category).alias("category_cd"), F.lit(label).alias("data_label"), value.alias("data_value"), visit_name.alias("visit_name")
        )

    readings = F.array(
        reading("Orders+Order_Priority", "Order Priority", F.col("o_orderpriority"), visit),
        reading("Orders+Amounts", "Total|Price % & Tax", money(F.col("o_totalprice")), visit),
        reading("Orders+DATALABEL+Codes", "Status_Code", F.concat(F.lit("|"), F.col("o_orderstatus"), F.lit("|x ( ) ,")), visit),
        reading("Orders+Segment+VISITNAME+DATALABEL", "Segment", F.concat(F.lit("("), F.col("c_mktsegment"), F.lit("  & co ,")), visit),
        reading("Site+Kind", "Kind", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.lit("Visit One")),
    )
    return base.select(
        F.lit("ORD").alias("study_id"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("site_id"),
        F.col("c_custkey").cast("string").alias("subject_id"), F.inline(readings),
    )


LANDING_SQL = r"""
base AS (
  SELECT 'ORD' AS study_id, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS site_id, CAST(c_custkey AS VARCHAR) AS subject_id,
         'Visit ' || year(o_orderdate) AS visit, o_orderpriority, o_totalprice, o_orderstatus, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
landing AS (
  SELECT study_id, site_id, subject_id, 'Orders+Order_Priority' AS category_cd, 'Order Priority' AS data_label, o_orderpriority AS data_value, visit AS visit_name FROM base
  UNION ALL SELECT study_id, site_id, subject_id, 'Orders+Amounts', 'Total|Price % & Tax', printf('%.2f', o_totalprice), visit FROM base
  UNION ALL SELECT study_id, site_id, subject_id, 'Orders+DATALABEL+Codes', 'Status_Code', '|' || o_orderstatus || '|x ( ) ,', visit FROM base
  UNION ALL SELECT study_id, site_id, subject_id, 'Orders+Segment+VISITNAME+DATALABEL', 'Segment', '(' || c_mktsegment || '  & co ,', visit FROM base
  UNION ALL SELECT study_id, site_id, subject_id, 'Site+Kind', 'Kind', CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'Visit One' FROM base)"""

KEYED_SQL = LANDING_SQL + r""",
keyed AS (
  SELECT *, replace(replace(category_cd, '_', ' '), '+', '\') AS category_path,
         regexp_replace(study_id || ':' || coalesce(site_id, '') || ':' || subject_id, '(::)+', ':', 'g') AS usubjid
  FROM landing WHERE data_value IS NOT NULL)"""

MARKS_SQL = KEYED_SQL + r""",
piped AS (
  SELECT * REPLACE (replace(trim(data_value, '|'), '|', '-') AS data_value, replace(data_label, '|', ',') AS data_label) FROM keyed),
open_done AS (
  SELECT * REPLACE (CASE WHEN contains(data_value, '()') OR contains(data_value, '( )') OR (contains(data_value, '(') AND NOT contains(data_value, ')'))
                    THEN replace(data_value, '(', '') ELSE data_value END AS data_value) FROM piped),
marks AS (
  SELECT * REPLACE (CASE WHEN contains(data_value, '()') OR contains(data_value, '( )') OR (contains(data_value, ')') AND NOT contains(data_value, '('))
                    THEN replace(data_value, ')', '') ELSE data_value END AS data_value) FROM open_done)"""

SINGLE_SQL = MARKS_SQL + r""",
single AS (
  SELECT * REPLACE (CASE WHEN category_cd IN (SELECT category_cd FROM marks GROUP BY category_cd HAVING count(DISTINCT upper(visit_name)) = 1)
                    THEN NULL ELSE visit_name END AS visit_name) FROM marks)"""

TRIM_SQL = SINGLE_SQL + r""",
trimmed AS (
  SELECT * REPLACE (
    CASE WHEN upper(string_split(category_path, '\')[-1]) = upper(data_label) THEN array_to_string(string_split(category_path, '\')[:-2], '\') ELSE category_path END AS category_path,
    CASE WHEN upper(string_split(category_path, '\')[-1]) = upper(data_label) THEN array_to_string(string_split(category_cd, '+')[:-2], '+') ELSE category_cd END AS category_cd)
  FROM single)"""

VISITS_SQL = TRIM_SQL + r""",
visits AS (
  SELECT * REPLACE (CASE WHEN visit_name = data_label OR visit_name = data_value OR (contains(category_cd, 'DATALABEL') AND NOT contains(category_cd, 'VISITNAME'))
                    THEN NULL ELSE visit_name END AS visit_name) FROM trimmed)"""

CLEAN_SQL = VISITS_SQL + r""",
spelled AS (
  SELECT * REPLACE (
    replace(replace(replace(replace(data_label, '%', ' Pct'), '&', ' and '), '+', ' and '), '_', ' ') AS data_label,
    replace(replace(replace(data_value, '%', ' Pct'), '&', ' and '), '+', ' and ') AS data_value,
    replace(replace(category_cd, '%', ' Pct'), '&', ' and ') AS category_cd,
    replace(replace(category_path, '%', ' Pct'), '&', ' and ') AS category_path) FROM visits),
clean AS (
  SELECT * REPLACE (
    rtrim(trim(replace(replace(data_label, '  ', ' '), ' ,', ',')), ',') AS data_label,
    rtrim(trim(replace(replace(data_value, '  ', ' '), ' ,', ',')), ',') AS data_value,
    rtrim(trim(replace(replace(visit_name, '  ', ' '), ' ,', ',')), ',') AS visit_name) FROM spelled)"""

NUMBER_SQL = r"'\s*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[nN][aA][nN])\s*'"

TYPED_SQL = CLEAN_SQL + r""",
numeric_vars AS (
  SELECT category_cd, data_label, visit_name FROM clean GROUP BY ALL HAVING bool_and(regexp_full_match(data_value, """ + NUMBER_SQL + r"""))),
typed AS (
  SELECT c.*, CASE WHEN n.category_cd IS NULL THEN 'T' ELSE 'N' END AS data_type
  FROM clean c LEFT JOIN numeric_vars n ON c.category_cd = n.category_cd AND c.data_label IS NOT DISTINCT FROM n.data_label
   AND c.visit_name IS NOT DISTINCT FROM n.visit_name)"""

NODES_SQL = TYPED_SQL + r""",
nodes AS (
  SELECT *, string_split(leaf_node, '\')[-2] AS node_name FROM (
  SELECT DISTINCT regexp_replace('\Public Studies\Ord\' ||
     CASE WHEN contains(category_path, 'DATALABEL') AND contains(category_path, 'VISITNAME')
       THEN replace(replace(category_path, 'DATALABEL', coalesce(data_label, '')), 'VISITNAME', coalesce(visit_name, '')) || CASE WHEN data_type = 'T' THEN '\' || data_value ELSE '' END
       WHEN contains(category_path, 'DATALABEL')
       THEN replace(category_path, 'DATALABEL', coalesce(data_label, '')) || CASE WHEN data_type = 'T' THEN '\' || data_value ELSE '' END
       ELSE category_path || '\' || coalesce(data_label, '') || CASE WHEN data_type = 'T' THEN '\' || data_value ELSE '' END || '\' || coalesce(visit_name, '') END || '\',
     '(\\){2,}', '\\', 'g') AS leaf_node,
    category_cd, visit_name, data_label, CASE WHEN data_type = 'T' THEN data_value END AS data_value, data_type
  FROM typed))"""
TOP_NODE = "\\Public Studies\\Ord\\"
