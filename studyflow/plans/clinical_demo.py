"""Queries of the clinical standardisation, on readings taken from orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.functions import paths as P
from studyflow.functions import text as T
from studyflow.operators import clinical as C
from studyflow.operators import grouping as G
from studyflow.operators import melt as ML
from studyflow.operators import routing as R
from studyflow.operators.numbering import number_rows, surrogate_ids
from studyflow.plans.data import (
    CLEAN_SQL, KEYED_SQL, LANDING_SQL, MARKS_SQL, NODES_SQL, SINGLE_SQL, TOP_NODE, TRIM_SQL, TYPED_SQL, VISITS_SQL, landing, money, t,
)
from studyflow.plans.registry import query
from studyflow.sources.tables import spread

# --- wide files: orders as a curated file of six columns -------------------

WIDE = ["site", "subject", "visit", "kind", "amount", "status"]

WIDE_SQL = """
wide AS (
  SELECT o_orderkey AS rec, 'S' || (o_custkey % 9) AS site, CAST(o_custkey AS VARCHAR) AS subject,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS visit, '"' || c_mktsegment || '*"' AS kind,
         CASE WHEN o_orderstatus = 'P' THEN '.' ELSE printf('%.2f', o_totalprice) END AS amount, o_orderstatus AS status
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def wide(spark, sf):
    orders = spread(t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), "o_orderkey")
    customer = t(spark, sf, "customer", "c_custkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("rec"), F.concat(F.lit("S"), (F.col("o_custkey") % 9).cast("string")).alias("site"),
        F.col("o_custkey").cast("string").alias("subject"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("visit"),
        F.concat(F.lit('"'), "c_mktsegment", F.lit('*"')).alias("kind"),
        F.when(F.col("o_orderstatus") == "P", ".").otherwise(money(F.col("o_totalprice"))).alias("amount"), F.col("o_orderstatus").alias("status"),
    )


def mapping(spark):
    return spark.createDataFrame([
        ("", 1, "SITE_ID", None), ("", 2, "SUBJ_ID", None), ("", 3, "VISIT_NAME", None), ("", 4, "OMIT", None),
        ("Orders+Amount", 5, "\\", "4A"), ("Orders+Status", 6, "Status%", None),
    ], "category_cd string, column_number int, data_label string, label_source string")


MELT_SQL = WIDE_SQL + r""",
who AS (SELECT rec, site AS site_id, subject AS subject_id, nullif(coalesce(visit, ''), '') AS visit_name, kind, amount, status FROM wide)"""


@query(rf"""WITH {MELT_SQL}
SELECT rec, 5 AS column_number, site_id, subject_id, visit_name, replace(trim(kind, '"'), '*', '') AS data_label, amount AS data_value,
  'Orders+DATALABEL+Amount' AS category_cd FROM who WHERE amount <> '.'
UNION ALL SELECT rec, 6, site_id, subject_id, visit_name, 'StatusPCT', status, 'Orders+Status' FROM who""")
def c01_melt_by_mapping(spark, sf):
    return ML.by_mapping(wide(spark, sf), mapping(spark), "rec", WIDE)


@query(f"WITH {MELT_SQL} SELECT rec, coalesce(site_id, '') AS site_id, subject_id, coalesce(visit_name, '') AS visit_name FROM who")
def c02_flatten_special_columns(spark, sf):
    cells = ML.to_cells(wide(spark, sf).repartition("rec"), "rec", WIDE)  # a record's cells meet where it lies
    return ML.record_columns(cells, mapping(spark), "rec", {"SITE_ID": "site_id", "SUBJ_ID": "subject_id", "VISIT_NAME": "visit_name"})


# One row per record and column of the wide table.
CELLS_SQL = WIDE_SQL + ",\ncells AS (" + " UNION ALL ".join(f"SELECT rec, {i + 1} AS column_number, '{c}' AS header, {c} AS value FROM wide" for i, c in enumerate(WIDE)) + ")"


@query(f"WITH {CELLS_SQL} SELECT rec, header AS label, value FROM cells")
def c03_label_from_header(spark, sf):
    cells = ML.to_cells(wide(spark, sf), "rec", WIDE)
    return cells.join(F.broadcast(ML.header_labels(WIDE, spark)), "column_number").select("rec", F.col("header").alias("label"), "value")


@query(f"""WITH {CELLS_SQL} SELECT rec, kind AS label, 'Orders+' || CASE WHEN rec % 2 = 0 THEN 'DATALABEL+' || header ELSE header || '+DATALABEL' END AS category_cd,
  value FROM cells JOIN wide USING (rec) WHERE header <> 'kind'""")
def c04_label_from_column(spark, sf):
    rows = wide(spark, sf)
    cells = ML.to_cells(rows, "rec", WIDE)
    labels = cells.where("column_number = 4").select("rec", F.col("value").alias("label"))
    side = F.when(F.col("rec") % 2 == 0, "A").otherwise("B")
    valued = cells.where("column_number <> 4").join(F.broadcast(ML.header_labels(WIDE, spark)), "column_number")
    return valued.join(labels, "rec").select(
        "rec", "label", T.insert_label_token(F.concat(F.lit("Orders+"), "header"), side).alias("category_cd"), "value"
    )


@query(f"""WITH {WIDE_SQL} SELECT rec, 'label' AS target, kind || ' ' || status AS label FROM wide
UNION ALL SELECT rec, 'value', concat_ws(' ', status, visit, subject) FROM wide""")
def c05_multi_source_parts(spark, sf):
    cells = ML.to_cells(wide(spark, sf).repartition("rec"), "rec", WIDE)
    sources = spark.createDataFrame(
        [(4, "label", 1), (6, "label", 2), (6, "value", 1), (3, "value", 2), (2, "value", 3)], "column_number int, target string, seq int"
    )
    return ML.joined_parts(cells, sources, "rec")


@query(f"""WITH {CELLS_SQL} SELECT rec, column_number, CASE WHEN header = 'status' AND value = 'F' THEN 'Filled' WHEN header = 'status' AND value = 'O' THEN 'Open'
  WHEN header = 'visit' AND value = '1-URGENT' THEN 'Baseline' ELSE value END AS value FROM cells""")
def c06_word_map(spark, sf):
    words = spark.createDataFrame(
        [(6, "F", "Filled"), (6, "O", "Open"), (3, "1-URGENT", "Baseline")], "column_number int, from_value string, to_value string"
    )
    return ML.word_map(ML.to_cells(wide(spark, sf), "rec", WIDE), words)





def _reduced(rule):
    def run(spark, sf):
        rows = t(spark, sf, "lineitem", "l_suppkey", "l_returnflag", F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"), "l_orderkey")
        out = G.reduce_duplicates(rows, ["l_suppkey", "l_returnflag"], "l_extendedprice", rule, "l_orderkey")
        return out.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))

    return run


for _rule, _agg in {
    "MIN": "min(l_extendedprice)", "MAX": "max(l_extendedprice)", "MEAN": "CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*)",
}.items():
    query(
        f"SELECT l_suppkey, l_returnflag, {_agg} AS l_extendedprice, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY l_suppkey, l_returnflag",
        name=f"c07_duplicates_{_rule.lower()}",
    )(_reduced(_rule))


@query("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def c08_drop_duplicate_rows(spark, sf):
    return t(spark, sf, "lineitem", "l_partkey", "l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query(f"WITH {CELLS_SQL} SELECT rec, column_number, value FROM cells WHERE value IS NOT NULL AND value <> '.'")
def c09_drop_missing(spark, sf):
    return ML.drop_missing(ML.to_cells(wide(spark, sf), "rec", WIDE))


@query(rf"""WITH {WIDE_SQL} SELECT rec, CASE WHEN visit IS NULL AND status = 'P' THEN NULL WHEN visit IS NULL THEN status
  WHEN status = 'P' THEN visit ELSE visit || '\' || status END AS visit_name FROM wide""")
def c10_merge_visits(spark, sf):
    second = F.when(F.col("status") != "P", F.col("status")).otherwise(" ")
    return wide(spark, sf).select("rec", ML.merge_visits(F.col("visit"), second).alias("visit_name"))


@query(r"""SELECT p_partkey, replace(replace(CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '"' || p_name || '"' END, ' ', 'PCT') , '_', '') || ' and ' || p_type AS clean FROM part""")
def c11_clean_column(spark, sf):
    dirty = F.concat(F.lit("  "), F.when(F.col("p_partkey") % 3 == 0, "*").otherwise("\\"), F.replace("p_name", F.lit(" "), F.lit("%")), F.lit("&"), "p_type", F.lit(" "))
    quoted = F.when(F.col("p_partkey") % 3 == 0, dirty).otherwise(
        F.concat(F.lit(' "'), F.lit('"'), F.replace("p_name", F.lit(" "), F.lit("%")), F.lit('"&'), "p_type", F.lit('" '))
    )
    return t(spark, sf, "part", "p_partkey", "p_name", "p_type").select("p_partkey", T.clean_column(quoted).alias("clean"))


KEEP = ["site_id", "subject_id", "category_cd", "data_label", "data_value", "visit_name"]


def _step(last, *columns):
    def run(spark, sf):
        rows = landing(spark, sf)
        for step in (C.add_keys, C.clean_marks, C.drop_single_visits, C.trim_repeated_label, C.drop_repeated_visits, C.spell_symbols, C.tidy):
            rows = step(rows)
            if step is last:
                break
        # Groups are hardly larger than a row, and none larger than a subject: combined after the shuffle only.
        keys = ["site_id", "usubjid", *columns]
        return rows.repartition(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))

    return run


for _name, _last, _sql, _view, _columns in [
    ("c12_paths_and_keys", C.add_keys, KEYED_SQL, "keyed", ["category_cd", "category_path", "data_value"]),
    ("c13_c14_pipes_and_parens", C.clean_marks, MARKS_SQL, "marks", ["category_cd", "data_label", "data_value"]),
    ("c15_single_visits", C.drop_single_visits, SINGLE_SQL, "single", ["category_cd", "data_label", "visit_name"]),
    ("c16_trim_repeated_label", C.trim_repeated_label, TRIM_SQL, "trimmed", ["category_cd", "category_path", "data_label"]),
    ("c17_repeated_visits", C.drop_repeated_visits, VISITS_SQL, "visits", ["category_cd", "visit_name", "data_value"]),
    ("c18_c19_symbols_and_spaces", C.tidy, CLEAN_SQL, "clean", ["category_cd", "category_path", "data_label", "data_value", "visit_name"]),
]:
    query(f"WITH {_sql} SELECT site_id, usubjid, {', '.join(_columns)}, count(*) AS n_rows FROM {_view} GROUP BY ALL", name=_name)(_step(_last, *_columns))


@query("SELECT doc_id, replace(trim(text, '|'), '|', '-') AS clean FROM documents")
def c13_pipes_in_documents(spark, sf):
    return t(spark, sf, "documents", "doc_id", "text").select("doc_id", T.clean_pipes("text").alias("clean"))


@query(r"""WITH a AS (SELECT doc_id, CASE WHEN contains(text, '()') OR contains(text, '( )') OR (contains(text, '(') AND NOT contains(text, ')')) THEN replace(text, '(', '') ELSE text END AS v FROM documents)
SELECT doc_id, CASE WHEN contains(v, '()') OR contains(v, '( )') OR (contains(v, ')') AND NOT contains(v, '(')) THEN replace(v, ')', '') ELSE v END AS clean FROM a""")
def c14_parens_in_documents(spark, sf):
    return t(spark, sf, "documents", "doc_id", "text").select("doc_id", T.clean_parens("text").alias("clean"))


@query(r"""SELECT doc_id, replace(replace(replace(replace(text, '%', ' Pct'), '&', ' and '), '+', ' and '), '_', ' ') AS clean FROM documents""")
def c18_symbols_in_documents(spark, sf):
    return t(spark, sf, "documents", "doc_id", "text").select("doc_id", T.words_for_symbols("text", plus=True, underscore=True).alias("clean"))


@query(r"""SELECT doc_id, rtrim(trim(replace(replace(text, '  ', ' '), ' ,', ',')), ',') AS clean FROM documents""")
def c19_spaces_in_documents(spark, sf):
    return t(spark, sf, "documents", "doc_id", "text").select("doc_id", T.tidy_spaces("text").alias("clean"))


@query(f"WITH {TYPED_SQL} SELECT category_cd, data_label, visit_name, data_type, count(*) AS n_rows FROM typed GROUP BY ALL")
def c20_type_inference(spark, sf):
    typed = C.infer_types(C.standardise(landing(spark, sf)))
    return typed.groupBy(*C.TYPE_KEYS, "data_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"WITH {TYPED_SQL} SELECT site_id, subject_id, visit_name, data_label, category_cd, count(*) AS n_rows FROM typed WHERE data_type = 'N' GROUP BY ALL HAVING count(*) > 1")
def c21_duplicate_numeric_keys(spark, sf):
    return C.duplicate_numeric_keys(C.infer_types(C.standardise(landing(spark, sf))))


@query("""SELECT 'Events+' || event_type AS category_cd, 'k' AS data_label, props AS data_value,
  count(*) FILTER (user_id % 10 = 0) AS null_ct, count(*) FILTER (user_id % 10 <> 0) AS non_null_ct FROM events GROUP BY event_type, props
HAVING count(*) FILTER (user_id % 10 = 0) > 0 AND count(*) FILTER (user_id % 10 <> 0) > 0""")
def c22_mixed_visits(spark, sf):
    rows = t(spark, sf, "events", "event_type", "props", "user_id").select(
        F.concat(F.lit("Events+"), "event_type").alias("category_cd"), F.lit("k").alias("data_label"), F.col("props").alias("data_value"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("visit_name"),
    )
    return C.mixed_visits(rows)


@query("""WITH d AS (SELECT user_id, event_type, CASE WHEN event_id % 50 = 0 THEN 'soon' ELSE strftime(ts, '%Y/%m/%d %H:%M') END AS visit_date FROM events)
SELECT user_id, event_type, count(*) AS n_rows, count(DISTINCT visit_date) AS n_dates, count(*) FILTER (visit_date = 'soon') AS n_bad_dates
FROM d GROUP BY user_id, event_type HAVING count(*) <> count(DISTINCT visit_date) OR count(*) FILTER (visit_date = 'soon') > 0""")
def c23_visit_date_report(spark, sf):
    rows = t(spark, sf, "events", "event_id", "user_id", "event_type", "ts").withColumn(
        "visit_date", F.when(F.col("event_id") % 50 == 0, "soon").otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm"))
    )
    return C.visit_date_report(rows, ["user_id", "event_type"], "visit_date")


@query(r"""WITH n AS (SELECT '\' || p_type || '\' || p_brand || '\' AS leaf_node FROM part WHERE p_size % 9 = 0
  UNION SELECT '\' || p_type || '\' || p_brand || '\' || p_name || '\' FROM part)
SELECT DISTINCT a.leaf_node FROM n a WHERE EXISTS (SELECT 1 FROM n b WHERE starts_with(b.leaf_node, a.leaf_node) AND b.leaf_node <> a.leaf_node)""")
def c24_parent_leaf_conflicts(spark, sf):
    part = t(spark, sf, "part", "p_type", "p_brand", "p_name", "p_size")
    short = part.where("p_size % 9 = 0").select(P.build("p_type", "p_brand").alias("leaf_node"))
    return C.parent_leaf_conflicts(short.union(part.select(P.build("p_type", "p_brand", "p_name"))).distinct())


@query(f"WITH {NODES_SQL} SELECT * FROM nodes")
def c25_leaf_nodes(spark, sf):
    return C.leaf_nodes(C.infer_types(C.standardise(landing(spark, sf))), TOP_NODE)


@query("""WITH r AS (
  SELECT 'S:' || o_custkey AS usubjid, 'Age' AS label, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_orderkey % 90 AS VARCHAR) END AS v FROM orders
  UNION ALL SELECT 'S:' || o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Gender' ELSE 'Patient (SEX)' END, o_orderstatus FROM orders WHERE o_custkey % 4 <> 0
  UNION ALL SELECT 'S:' || o_custkey, 'Race', o_orderpriority FROM orders WHERE o_custkey % 3 <> 0)
SELECT usubjid, CAST(coalesce(max(CASE WHEN label = 'Age' THEN coalesce(try_cast(v AS DOUBLE), 0) END), 0) AS INTEGER) AS age,
  coalesce(max(CASE WHEN label IN ('Gender', 'Patient (SEX)') THEN v END), 'Unknown') AS sex, max(CASE WHEN label = 'Race' THEN v END) AS race
FROM r GROUP BY usubjid""")
def c26_demographics(spark, sf):
    orders = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")

    def reading(label, value, when):
        return F.when(when, F.struct(label.alias("data_label"), value.alias("data_value")))

    always = F.lit(True)
    readings = F.array(
        reading(F.lit("Age"), F.when(F.col("o_orderstatus") == "P", "n/a").otherwise((F.col("o_orderkey") % 90).cast("string")), always),
        reading(F.when(F.col("o_orderkey") % 2 == 0, "Gender").otherwise("Patient (SEX)"), F.col("o_orderstatus"), F.col("o_custkey") % 4 != 0),
        reading(F.lit("Race"), F.col("o_orderpriority"), F.col("o_custkey") % 3 != 0),
    )
    rows = orders.select(F.concat(F.lit("S:"), F.col("o_custkey").cast("string")).alias("usubjid"), F.inline(F.array_compact(readings)))
    return C.demographics(rows)


@query(f"""WITH {NODES_SQL},
people AS (SELECT DISTINCT usubjid AS subject_key FROM typed),
patients AS (SELECT subject_key, row_number() OVER (ORDER BY substr(md5(subject_key), 1, 3), subject_key) AS patient_num FROM people),
concepts AS (SELECT leaf_node, row_number() OVER (ORDER BY substr(md5(leaf_node), 1, 3), leaf_node) AS concept_cd FROM (SELECT DISTINCT leaf_node FROM nodes)),
leaves AS (SELECT * FROM nodes a WHERE NOT EXISTS (SELECT 1 FROM nodes b WHERE starts_with(b.leaf_node, a.leaf_node) AND b.leaf_node <> a.leaf_node))
SELECT DISTINCT p.patient_num, c.concept_cd, r.study_id, r.data_type AS value_type, CASE WHEN r.data_type = 'T' THEN r.data_value ELSE 'E' END AS text_value,
  CASE WHEN r.data_type = 'N' THEN CAST(r.data_value AS DOUBLE) END AS number_value
FROM typed r JOIN patients p ON r.usubjid = p.subject_key
JOIN leaves n ON r.category_cd = n.category_cd AND r.data_label IS NOT DISTINCT FROM n.data_label AND r.visit_name IS NOT DISTINCT FROM n.visit_name
  AND CASE WHEN r.data_type = 'T' THEN r.data_value END IS NOT DISTINCT FROM n.data_value
JOIN concepts c ON n.leaf_node = c.leaf_node""")
def c27_facts(spark, sf):
    typed = C.infer_types(C.standardise(landing(spark, sf)))
    nodes = C.leaf_nodes(typed, TOP_NODE)
    patients = surrogate_ids(typed.select(F.col("usubjid").alias("subject_key")).distinct(), ["subject_key"], "patient_num")
    concepts = surrogate_ids(nodes.select(F.col("leaf_node").alias("concept_path")).distinct(), ["concept_path"], "concept_cd")
    return C.facts(typed, patients, nodes, concepts, TOP_NODE)


@query("""SELECT o_orderkey, o_orderpriority AS category_cd, CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' END AS display_value,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' END AS display_label, CASE o_orderpriority WHEN '1-URGENT' THEN 'days' END AS display_unit FROM orders""")
def c28_display_mapping(spark, sf):
    display = spark.createDataFrame(
        [("1-URGENT", "U", "Urgent", "days"), ("2-HIGH", "H", "High", None)],
        "category_cd string, display_value string, display_label string, display_unit string",
    )
    rows = t(spark, sf, "orders", "o_orderkey", F.col("o_orderpriority").alias("category_cd"))
    return ML.display_mapping(rows, display)


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) AS seq FROM lineitem)
SELECT l_suppkey, l_orderkey, 'Shipment ' || CASE WHEN l_returnflag = 'N' THEN '-1' ELSE lpad(CAST(seq AS VARCHAR), 5, '0') END AS label,
  strftime(l_shipdate, '%d-%m-%y') AS sequence_value FROM n""")
def c30_sequence_columns(spark, sf):
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    rows = t(spark, sf, "lineitem", "l_suppkey", "l_returnflag", *keys)
    numbered = number_rows(rows, keys, ["l_suppkey", "l_returnflag"], F.to_date("l_shipdate"), "seq")
    number = F.when(F.col("l_returnflag") != "N", F.col("seq"))
    return numbered.select(
        "l_suppkey", "l_orderkey", F.concat(F.lit("Shipment "), ML.mask_sequence(number, 5)).alias("label"),
        ML.reformat(F.date_format("l_shipdate", "yyyyMMdd"), "CcYyMmDd", "Dd-Mm-Yy").alias("sequence_value"),
    )


@query("""WITH r AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'ENROLL_DATE' ELSE 'VISIT_DATE' END AS label,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'enrol.txt' ELSE o_orderstatus || '.txt' END AS file_name, o_custkey FROM orders)
SELECT label, count(DISTINCT file_name) AS n_files, count(DISTINCT o_custkey) AS n_subjects, count(DISTINCT file_name) <= 1 AS valid FROM r GROUP BY label""")
def c31_label_files_report(spark, sf):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rows = t(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority").select(
        F.when(urgent, "ENROLL_DATE").otherwise("VISIT_DATE").alias("label"),
        F.when(urgent, "enrol.txt").otherwise(F.concat("o_orderstatus", F.lit(".txt"))).alias("file_name"), "o_custkey",
    )
    return ML.label_files_report(rows, "label", "file_name", "o_custkey")


PATIENTS_SQL = """
old AS (SELECT c_custkey + 1 AS patient_num, 'S:' || c_custkey AS subject_key, CAST(c_nationkey AS INTEGER) AS age, 'F' AS sex, CAST(NULL AS VARCHAR) AS race FROM customer WHERE c_custkey % 4 <> 0),
incoming AS (SELECT 'S:' || c_custkey AS subject_key, CAST(c_nationkey + 1 AS INTEGER) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'M' END AS sex, c_mktsegment AS race FROM customer WHERE c_custkey % 5 <> 0),
used AS (SELECT patient_num FROM old WHERE patient_num % 10 = 1),
kept AS (SELECT * FROM old WHERE subject_key IN (SELECT subject_key FROM incoming) OR patient_num IN (SELECT patient_num FROM used))"""


@query(f"""WITH {PATIENTS_SQL}
SELECT k.patient_num, k.subject_key, CASE WHEN i.subject_key IS NULL THEN k.age ELSE i.age END AS age, coalesce(i.sex, k.sex) AS sex, coalesce(i.race, k.race) AS race
FROM kept k LEFT JOIN incoming i ON k.subject_key = i.subject_key
UNION ALL SELECT row_number() OVER (ORDER BY substr(md5(subject_key), 1, 3), subject_key) + (SELECT max(patient_num) FROM old), subject_key, age, sex, race
FROM incoming WHERE subject_key NOT IN (SELECT subject_key FROM kept)""")
def c32_merge_patients(spark, sf):
    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    key = F.concat(F.lit("S:"), F.col("c_custkey").cast("string")).alias("subject_key")
    old = customer.where("c_custkey % 4 <> 0").select(
        (F.col("c_custkey") + 1).alias("patient_num"), key, F.col("c_nationkey").alias("age"), F.lit("F").alias("sex"), F.lit(None).cast("string").alias("race")
    )
    incoming = customer.where("c_custkey % 5 <> 0").select(
        key, (F.col("c_nationkey") + 1).alias("age"), F.when(F.col("c_custkey") % 2 == 0, "M").alias("sex"), F.col("c_mktsegment").alias("race")
    )
    used = old.where("patient_num % 10 = 1").select("patient_num")
    return C.merge_patients(old, incoming, "S", used, keep_known=True)


@query("""SELECT 'FAM:' || c_custkey AS subject_key, CASE c_nationkey % 3 WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS sex
FROM customer WHERE c_custkey % 7 <> 0""")
def c33_pedigree_patients(spark, sf):
    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey")
    ped = customer.select(
        F.concat(F.lit(" G"), F.col("c_custkey").cast("string"), F.lit("T")).alias("individual_id"), (F.col("c_nationkey") % 3).cast("string").alias("sex_code")
    )
    known = customer.where("c_custkey % 7 = 0").select(F.concat(F.lit("FAM:"), F.col("c_custkey").cast("string")).alias("subject_key"))
    return C.pedigree_patients(ped, "FAM", known)


@query("""SELECT l_orderkey, l_linenumber, concat_ws(' ', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), CASE l_returnflag WHEN 'A' THEN 'boxes' WHEN 'R' THEN 'pieces' END) AS value
FROM lineitem WHERE l_linestatus <> 'F'""")
def c34_units(spark, sf):
    units = spark.createDataFrame([("A", "boxes"), ("R", "pieces"), ("N", " ")], "l_returnflag string, unit string")
    rows = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    kept = R.split(rows, F.col("l_linestatus") == "F")[1]
    return kept.join(units, "l_returnflag", "left").select(
        "l_orderkey", "l_linenumber", ML.append_unit(F.col("l_quantity").cast("int").cast("string"), F.col("unit")).alias("value")
    )


@query("""WITH d AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'unknown' WHEN event_id % 2 = 0 THEN strftime(ts, '%Y/%m/%d') ELSE strftime(ts, '%d-%m-%Y %H:%M') END AS d,
  CASE WHEN event_id % 3 = 0 THEN '07:30' END AS tm, ts FROM events)
SELECT event_id, CASE WHEN d IS NULL AND tm IS NOT NULL THEN 'TIME_WITHOUT_DATE' WHEN d IS NULL THEN 'MISSING' WHEN d = 'unknown' THEN 'BAD_DATE' ELSE 'OK' END AS visit_date_status,
  CASE WHEN d IS NULL OR d = 'unknown' THEN NULL WHEN event_id % 2 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%Y-%m-%d') || ' ' || coalesce(tm, '00:00') END AS visit_text FROM d""")
def c35_parse_dates(spark, sf):
    events = t(spark, sf, "events", "event_id", "ts")
    e = F.col("event_id")
    rows = events.select(
        "event_id",
        F.when(e % 11 == 0, None).when(e % 7 == 0, "unknown").when(e % 2 == 0, F.date_format("ts", "yyyy/MM/dd")).otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm")).alias("d"),
        F.when(e % 3 == 0, "07:30").alias("tm"),
    )
    parsed = ML.parse_dates(rows, "d", ["yyyy/MM/dd HH:mm", "yyyy/MM/dd", "dd-MM-yyyy HH:mm"], "tm")
    return parsed.select("event_id", "visit_date_status", F.date_format("visit_date", "yyyy-MM-dd HH:mm").alias("visit_text"))


DATES_SQL = """dates AS (SELECT event_id, CAST(user_id AS VARCHAR) AS subject,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'unknown' WHEN event_id % 5 = 0 THEN strftime(ts, '%Y/%m/%d %H:%M') ELSE strftime(ts, '%Y/%m/%d') END AS visit,
  CASE WHEN event_id % 3 = 0 THEN '07:30' END AS tm, strftime(ts, '%d-%m-%Y') AS enrol, ts FROM events),
dated AS (SELECT event_id, subject AS subject_id, 'VISIT_DATE' AS data_label, 2 AS column_number,
  CASE WHEN visit IS NULL OR visit = 'unknown' THEN NULL WHEN event_id % 5 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%Y-%m-%d') || ' ' || coalesce(tm, '00:00') END AS date,
  CASE WHEN visit IS NULL AND tm IS NOT NULL THEN 'TIME_WITHOUT_DATE' WHEN visit IS NULL THEN 'MISSING' WHEN visit = 'unknown' THEN 'BAD_DATE' ELSE 'OK' END AS status FROM dates
 UNION ALL SELECT event_id, subject, 'ENROLL_DATE', 4, strftime(ts, '%Y-%m-%d') || ' 00:00', 'OK' FROM dates)"""


def dated(spark, sf):
    e = F.col("event_id")
    rows = t(spark, sf, "events", "event_id", "user_id", "ts").select(
        "event_id", F.col("user_id").cast("string").alias("subject"),
        F.when(e % 11 == 0, None).when(e % 7 == 0, "unknown").when(e % 5 == 0, F.date_format("ts", "yyyy/MM/dd HH:mm")).otherwise(F.date_format("ts", "yyyy/MM/dd")).alias("visit"),
        F.when(e % 3 == 0, "07:30").alias("tm"), F.date_format("ts", "dd-MM-yyyy").alias("enrol"),
    )
    rules = spark.createDataFrame(
        [("1", "SUBJ_ID", None, None), ("2", "VISIT_DATE", "yyyy/MM/dd", "3"), ("3", "OMIT", " ", None), ("4", "ENROLL_DATE", "dd-MM-yyyy", None)],
        "column_number string, data_label string, date_format string, time_column string",
    )
    return ML.dates_by_mapping(rows, rules, "event_id", "subject", ["subject", "visit", "tm", "enrol"])


@query(f"WITH {DATES_SQL} SELECT * FROM dated")
def c35_dates_by_mapping(spark, sf):
    return dated(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm"))


@query(f"WITH {DATES_SQL} SELECT subject_id, min(date) AS enrol_date, count(DISTINCT date) AS n_dates, CAST(0 AS BIGINT) AS n_unreadable FROM dated WHERE data_label = 'ENROLL_DATE' GROUP BY subject_id")
def c35_enrol_dates(spark, sf):
    return ML.enrol_dates(dated(spark, sf)).withColumn("enrol_date", F.date_format("enrol_date", "yyyy-MM-dd HH:mm"))


@query(f"""WITH {WIDE_SQL} SELECT 'unmapped' AS problem, header AS column_name, n_values FROM (
  SELECT 'kind' AS header, count(kind) AS n_values FROM wide UNION ALL SELECT 'amount', count(amount) FROM wide)
UNION ALL SELECT 'label column missing', 'status', count(status) FROM wide""")
def c36_mapping_report(spark, sf):
    rows = wide(spark, sf)
    headers = ML.header_labels(WIDE, spark)
    rules = spark.createDataFrame(
        [("", 1, "SITE_ID", None), ("", 2, "SUBJ_ID", None), ("", 3, "VISIT_NAME", None), ("Orders+Status", 6, "\\", "12B")],
        "category_cd string, column_number int, data_label string, label_source string",
    )
    problems = ML.unmapped_columns(headers, rules).select("column_number", F.lit("unmapped").alias("problem")).unionByName(
        ML.unresolved_labels(rules, headers).select("column_number", F.lit("label column missing").alias("problem"))
    )
    counted = ML.to_cells(rows, "rec", WIDE).groupBy("column_number").agg(F.count("value").alias("n_values"))
    return problems.join(headers, "column_number").join(counted, "column_number").select(
        "problem", F.col("header").alias("column_name"), "n_values"
    )
