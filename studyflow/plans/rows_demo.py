"""Queries of sources, sinks and row-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.functions import paths as P
from studyflow.functions import stats as S
from studyflow.functions import text as T
from studyflow.operators import joins as J
from studyflow.operators import merge as M
from studyflow.operators import routing as R
from studyflow.operators.numbering import number_rows
from studyflow.plans.data import NUMBER_SQL, money, t
from studyflow.plans.registry import query
from studyflow.session import work_path
from studyflow.sources import files as FI
from studyflow.sources import tables as TB

# --- A: scans and sinks ----------------------------------------------------


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, printf('%.2f', o_totalprice) AS price FROM orders")
def a01_delimited_scan(spark, sf):
    path = work_path(spark, "orders-tab")
    rows = t(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    FI.write_text(rows.select(F.col("o_orderkey").cast("string"), "o_orderpriority", money(F.col("o_totalprice")).alias("price")), path)
    return FI.read_delimited(spark, path, ["o_orderkey", "o_orderpriority", "price"])


@query("""SELECT 'ORD' || o_orderstatus AS study, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'L' ELSE 'Z' END AS data_type, 'GPL' || (1000 + o_orderkey % 3) AS platform,
  count(*) AS n_rows FROM orders GROUP BY ALL""")
def a02_file_names(spark, sf):
    letter = R.map_values(t(spark, sf, "orders", "o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "R", "O": "L"}, "Z", "letter")
    named = letter.select(F.concat(
        F.lit("/studies/ORD/"), F.lit("ORD"), "o_orderstatus", F.lit("_GPL"), (F.col("o_orderkey") % 3 + 1000).cast("string"), F.lit("_"), "letter", F.lit(".txt")
    ).alias("file_path"))
    described = FI.describe_names(named).withColumn("study", F.regexp_replace("study", "_GPL[0-9]+$", ""))
    return described.groupBy("study", "data_type", "platform").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT 's_suppkey=' || (s_suppkey % 4) AS folder, count(*) AS n_rows FROM supplier GROUP BY ALL")
def a02_listed_parts(spark, sf):
    path = work_path(spark, "supplier-parts")
    rows = t(spark, sf, "supplier", "s_name", (F.col("s_suppkey") % 4).alias("s_suppkey"))
    rows.write.partitionBy("s_suppkey").option("sep", "\t").csv(path)
    files = FI.list_files(spark, path, "*.csv").select(F.substring_index("file_path", "/", -1).alias("file_name"))
    lines = FI.read_lines(spark, path + "/*/*.csv").withColumn("file_name", FI.file_name(F.col("file_path")))
    return lines.join(files.distinct(), "file_name", "left_semi").groupBy(
        F.element_at(F.split("file_path", "/"), -2).alias("folder")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT s_name AS study_id, 'Study of ' || s_name AS title FROM supplier WHERE s_suppkey % 5 <> 0")
def a03_metadata_sheet(spark, sf):
    from studyflow.operators.ontology import header_metadata

    path = work_path(spark, "sheet")
    rows = t(spark, sf, "supplier", "s_suppkey", "s_name").select(
        F.col("s_name").alias("study_id"), F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("Study of "), "s_name")).alias("title")
    )
    FI.write_text(rows, path)
    return header_metadata(FI.read_delimited(spark, path))[0]


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3")
def a04_table_scan(spark, sf):
    return TB.read_table(spark, sf, "nation").where("n_regionkey = 3").select("n_nationkey", "n_name")


@query("""SELECT o_orderkey, v.weight FROM orders JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 3)) v(p, weight) ON o_orderpriority = v.p""")
def a05_literal_rows(spark, sf):
    weights = TB.literal_rows(spark, [("1-URGENT", 5), ("2-HIGH", 3)], "o_orderpriority string, weight int")
    return t(spark, sf, "orders", "o_orderkey", "o_orderpriority").join(weights, "o_orderpriority").select("o_orderkey", "weight")


@query("SELECT c_mktsegment, count(*) * 2 AS n_rows FROM customer GROUP BY c_mktsegment")
def a06_append(spark, sf):
    path = work_path(spark, "customers")
    rows = t(spark, sf, "customer", "c_custkey", "c_mktsegment")
    TB.append(rows, path)
    TB.append(rows, path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT CASE WHEN regexp_full_match(props, '.*[5-9]}') THEN 'rejects' ELSE 'valid' END AS side, count(*) AS n_rows FROM events GROUP BY ALL""")
def a07_text_sink_with_rejects(spark, sf):
    path = work_path(spark, "events")
    rows = t(spark, sf, "events", "event_id", "props")
    FI.write_with_rejects(rows, ~F.rlike("props", F.lit("[5-9]}$")), path + "/valid", path + "/rejects")
    both = FI.read_lines(spark, path + "/*/*.csv").where(~F.startswith("line", F.lit("event_id")))
    return both.groupBy(F.element_at(F.split("file_path", "/"), -2).alias("side")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT o_orderstatus AS study_id, count(*) AS n_rows, CASE WHEN o_orderstatus = 'F' THEN 'reloaded' ELSE 'first' END AS load FROM orders
WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0 GROUP BY ALL""")
def a08_replace_by_study(spark, sf):
    path = work_path(spark, "history")
    rows = t(spark, sf, "orders", "o_orderkey", F.col("o_orderstatus").alias("study_id"))
    TB.load_history(rows.withColumn("load", F.lit("first")), path, "study_id")
    TB.load_history(rows.where("study_id = 'F' and o_orderkey % 2 = 0").withColumn("load", F.lit("reloaded")), path, "study_id")
    return spark.read.parquet(path).groupBy("study_id", "load").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice * 2 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0""")
def a08_replace_lazily(spark, sf):
    old = t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    new = old.where("o_orderstatus = 'F' and o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return M.replace_where(old, new, "o_orderstatus")


@query("SELECT l_returnflag AS study_id, l_linestatus AS source_cd, count(*) AS n_rows, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ALL")
def a09_partition_load(spark, sf):
    path = work_path(spark, "partitions")
    rows = t(spark, sf, "lineitem", F.col("l_returnflag").alias("study_id"), F.col("l_linestatus").alias("source_cd"), "l_quantity")
    TB.replace_partitions(rows, path, ["study_id", "source_cd"])
    TB.replace_partitions(rows.where("study_id = 'R'"), path, ["study_id", "source_cd"])
    return spark.read.parquet(path).groupBy("study_id", "source_cd").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query("SELECT 'nation' AS table_name, count(*) AS n_rows FROM nation UNION ALL SELECT 'customer', count(*) FROM customer")
def a10_snapshot(spark, sf):
    folder = work_path(spark, "snapshot")
    TB.snapshot({n: t(spark, sf, n) for n in ("nation", "customer")}, folder)
    parts = [spark.read.parquet(f"{folder}/{n}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in ("nation", "customer")]
    return parts[0].unionByName(parts[1])


@query(r"""SELECT 'file:/load/' || r_name || '/' || n_name || '/' || kind || '/' || c_custkey AS file_path, '\' || r_name || '\' || n_name || '\' AS node, kind
FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'ClinicalData' ELSE 'ExpressionData' END AS kind FROM customer) JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def a11_study_folders(spark, sf):
    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey")
    nation, region = t(spark, sf, "nation"), t(spark, sf, "region")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    kind = F.when(F.col("c_custkey") % 2 == 0, "ClinicalData").otherwise("ExpressionData")
    paths = named.select(F.concat_ws("/", F.lit("file:/load"), "r_name", "n_name", kind, F.col("c_custkey").cast("string")).alias("file_path"))
    return FI.folder_route(paths).select("file_path", "node", "kind")


STUDIES_SQL = r"""
placed AS (SELECT n_regionkey AS r, CASE WHEN n_regionkey < 3 THEN 1 ELSE 2 END AS load, 'STUDY' || n_regionkey AS study, '\Node' || n_regionkey % 2 || '\STUDY' || n_regionkey || '\' AS node, * FROM nation),
people AS (SELECT load, study, node, CAST(s_suppkey AS VARCHAR) AS id, n_name, printf('%.2f', s_acctbal) AS balance FROM supplier JOIN placed ON s_nationkey = n_nationkey)"""


def study_files(spark, sf, root, regions):
    """Text files of some regions as studies: patients with a header, a matrix, and a sample map without header."""
    nation = t(spark, sf, "nation")
    people = t(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    amount = F.format_string("%.2f", "s_acctbal")
    for r in regions:
        folder, mine = f"{root}/Node{r % 2}/STUDY{r}", people.where(F.col("n_regionkey") == r)
        matrix = nation.where(F.col("n_regionkey") == r).select("n_nationkey", F.concat_ws("\t", F.concat(F.lit("P"), F.col("n_nationkey").cast("string")), F.col("n_nationkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, "1.5").otherwise("null")).alias("line"))
        rows = {
            "ClinicalData": ("SUBJ_ID\tNATION\tBALANCE", mine.select("s_suppkey", F.concat_ws("\t", F.col("s_suppkey").cast("string"), "n_name", amount).alias("line"))),
            "ExpressionDataToUpload": ("ID_REF\tGSM1\tGSM2", matrix.withColumnRenamed("n_nationkey", "s_suppkey")),
            "SampleMap": (None, mine.select("s_suppkey", F.concat_ws("\t", F.lit(f"STUDY{r}"), F.lit(""), F.col("s_suppkey").cast("string"), F.concat(F.lit("GSM"), F.col("s_suppkey").cast("string")), F.lit("GPL1"), "n_name", F.lit(""), F.lit(""), F.lit("Samples+PLATFORM")).alias("line"))),
        }
        for kind, (header, lines) in rows.items():
            if header:
                lines = lines.unionByName(spark.createDataFrame([(-1, header)], "s_suppkey long, line string"))
            lines.coalesce(1).sortWithinPartitions("s_suppkey").select("line").write.text(f"{folder}/{kind}")


@query(rf"""WITH {STUDIES_SQL}
SELECT load, 'clinical' AS kind, study, node, id AS item, 'NATION' AS column, n_name AS value FROM people UNION ALL SELECT load, 'clinical', study, node, id, 'BALANCE', balance FROM people
UNION ALL SELECT load, 'expression', study, node, 'P' || n_nationkey, 'GSM1', CAST(n_nationkey AS VARCHAR) FROM placed
UNION ALL SELECT load, 'expression', study, node, 'P' || n_nationkey, 'GSM2', '1.5' FROM placed WHERE n_nationkey % 2 = 0
UNION ALL SELECT load, 'samples', study, node, 'GSM' || id, c, CASE c WHEN 'study_id' THEN study WHEN 'subject_id' THEN id WHEN 'sample_cd' THEN 'GSM' || id WHEN 'platform' THEN 'GPL1' WHEN 'tissue_type' THEN n_name ELSE 'Samples+PLATFORM' END
  FROM people, (SELECT unnest(['study_id', 'subject_id', 'sample_cd', 'platform', 'tissue_type', 'category_cd']) AS c)""")
def a11_folder_load(spark, sf):
    """Two loads of one tree of folders: the second one finds two more studies and reads only those."""
    from studyflow.sources import study_folder as SF

    root, target = work_path(spark, "studies"), work_path(spark, "loaded")
    study_files(spark, sf, root, (0, 1, 2))
    SF.load(spark, root, target)
    study_files(spark, sf, root, (3, 4))
    SF.load(spark, root, target)
    kinds = [SF.loaded_rows(spark, target, k).withColumn("kind", F.lit(k)) for k in ("clinical", "expression", "samples")]
    rows = kinds[0].unionByName(kinds[1], allowMissingColumns=True).unionByName(kinds[2], allowMissingColumns=True)
    return rows.select("load", "kind", "study", "node", "item", "column", "value")


# --- B: projection, filter, routing ----------------------------------------


@query("SELECT l_partkey AS part, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_orderkey AS VARCHAR) AS order_id FROM lineitem")
def b01_select_rename_retype(spark, sf):
    return R.retype(t(spark, sf, "lineitem"), {
        "l_partkey": ("part", "bigint"), "l_quantity": ("quantity", "int"), "l_orderkey": ("order_id", "string"),
    })


@query("""SELECT l_returnflag, l_linestatus, coalesce((l_quantity > 25 AND l_discount <= 0.05) OR l_returnflag IN ('R') OR contains(l_linestatus, 'O'), false) AS branch,
  count(*) AS n_rows FROM lineitem GROUP BY ALL""")
def b02_predicate_split(spark, sf):
    rows = t(spark, sf, "lineitem", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    test = ((F.col("l_quantity") > 25) & (F.col("l_discount") <= 0.05)) | F.col("l_returnflag").isin("R") | T.has("l_linestatus", "O")
    yes, no = R.split(rows, test)
    both = yes.withColumn("branch", F.lit(True)).unionByName(no.withColumn("branch", F.lit(False)))
    return both.groupBy("l_returnflag", "l_linestatus", "branch").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'archive' WHEN 'O' THEN 'queue' ELSE 'review' END AS route FROM orders")
def b03_switch(spark, sf):
    return R.switch(t(spark, sf, "orders", "o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "archive", "O": "queue"}, "review").select("o_orderkey", "route")


@query("SELECT o_orderkey, 'ORD' AS study_id, 1 AS version, o_orderpriority AS label FROM orders")
def b04_constants(spark, sf):
    rows = R.set_constants(t(spark, sf, "orders", "o_orderkey", "o_orderpriority"), {"study_id": "ORD", "version": 1}, {"label": "o_orderpriority"})
    return rows.drop("o_orderpriority")


@query("SELECT event_id, coalesce(nullif(event_type, 'error'), 'none') AS event_type FROM events")
def b05_null_defaults(spark, sf):
    return R.default_nulls(t(spark, sf, "events", "event_id", "event_type"), {"event_type": "none"}, {"event_type": "error"})


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def b06_value_mapping(spark, sf):
    return R.map_values(t(spark, sf, "orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", {"1-URGENT": "U", "2-HIGH": "H"})


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders")
def b07_row_number(spark, sf):
    rows = t(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return number_rows(rows, ["o_orderdate", "o_orderkey"], slice_by=F.to_date("o_orderdate")).select("o_orderkey", "row_num")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_num FROM orders")
def b07_row_number_by_range(spark, sf):
    rows = t(spark, sf, "orders", "o_orderkey", "o_totalprice")
    return number_rows(rows, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "row_num")


@query("""SELECT l_suppkey, l_orderkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS seq FROM lineitem""")
def b08_sequence_per_key(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    rows = t(spark, sf, "lineitem", "l_suppkey", *order)
    return number_rows(rows, order, ["l_suppkey"], F.to_date("l_shipdate"), "seq").select("l_suppkey", "l_orderkey", "seq")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice + l_tax, 2) AS a_plus_b, round(l_extendedprice + l_tax + l_discount, 2) AS a_plus_b_plus_c,
  l_orderkey - l_partkey AS a_minus_b, l_returnflag || l_linestatus AS joined FROM lineitem""")
def b09_calculator(spark, sf):
    return t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") + F.col("l_tax"), 2).alias("a_plus_b"),
        F.round(F.col("l_extendedprice") + F.col("l_tax") + F.col("l_discount"), 2).alias("a_plus_b_plus_c"),
        (F.col("l_orderkey") - F.col("l_partkey")).alias("a_minus_b"), F.concat("l_returnflag", "l_linestatus").alias("joined"),
    )


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_mktsegment = 'MACHINERY' THEN 'segment' END, CASE WHEN c_acctbal < 0 THEN 'balance' END) AS missing_fields FROM customer""")
def b10_required_fields(spark, sf):
    rows = t(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise("  ").alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    return R.check_required(rows, ["segment", "balance"]).select("c_custkey", "missing_fields")


EVENT_VALUE_SQL = "CASE WHEN event_id % 6 = 0 THEN props WHEN event_id % 6 = 1 THEN '.' ELSE printf('%.2f', value) END"


def event_values(spark, sf):
    e = F.col("event_id") % 6
    return t(spark, sf, "events", "event_id", "event_type", "props", "value").select(
        "event_id", "event_type", F.when(e == 0, F.col("props")).when(e == 1, ".").otherwise(money(F.col("value"))).alias("v")
    )


@query(f"SELECT event_id, try_cast({EVENT_VALUE_SQL} AS DOUBLE) AS v FROM events")
def b11_numeric_or_null(spark, sf):
    return R.numeric_or_null(event_values(spark, sf).select("event_id", "v"), ["v"])


@query(f"SELECT event_id, try_cast({EVENT_VALUE_SQL} AS DOUBLE) AS v FROM events WHERE try_cast({EVENT_VALUE_SQL} AS DOUBLE) IS NOT NULL")
def b12_numeric_only(spark, sf):
    return R.numeric_only(event_values(spark, sf).select("event_id", "v"), "v")


@query("SELECT p_partkey, coalesce(CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'R1' WHEN 'blue' THEN 'B1' END, split_part(p_name, ' ', 1)) AS sample_cd FROM part")
def b13_sample_suffix_and_map(spark, sf):
    names = spark.createDataFrame([("red", "R1"), ("blue", "B1")], "name string, code string")
    rows = t(spark, sf, "part", "p_partkey", "p_name")
    return R.strip_and_map_samples(rows, "p_name", " .*$", names, "name", "code").select("p_partkey", "sample_cd")


@query("""SELECT 3 AS expected_columns, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS n_columns, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_probes,
  o_orderstatus <> 'P' AS valid FROM orders GROUP BY o_orderstatus = 'P', o_orderstatus <> 'P'""")
def b14_column_counts(spark, sf):
    orders = t(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    lines = orders.select(F.concat_ws(
        "\t", F.col("o_custkey").cast("string"), "o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    ).alias("line"))
    return FI.column_count_report(lines, "ID\tpriority\tstatus")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem JOIN (VALUES ('R', 7), ('A', 1)) v(f, n) ON l_returnflag = v.f AND l_linenumber = v.n)""")
def b15_exclude_records(spark, sf):
    listed = spark.createDataFrame([("R", 7), ("A", 1)], "l_returnflag string, l_linenumber int")
    rows = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return R.exclude_records(rows, listed, "l_orderkey", ["l_returnflag", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


# --- L: scalar functions ----------------------------------------------------


@query(f"""SELECT event_id, regexp_full_match(v, {NUMBER_SQL}) AS numeric, try_strptime(d, '%Y%m%d') IS NOT NULL AS dated FROM (
  SELECT event_id, {EVENT_VALUE_SQL} AS v, CASE WHEN event_id % 4 = 0 THEN props ELSE strftime(ts, '%Y%m%d') END AS d FROM events)""")
def l01_is_numeric_is_date(spark, sf):
    dates = t(spark, sf, "events", "event_id", "ts", "props").select(
        "event_id", F.when(F.col("event_id") % 4 == 0, F.col("props")).otherwise(F.date_format("ts", "yyyyMMdd")).alias("d")
    )
    return event_values(spark, sf).join(dates, "event_id").select("event_id", T.is_numeric("v").alias("numeric"), T.is_date("d").alias("dated"))


ERF_SQL = """(1 - t * exp(-x*x - 1.26551223 + t*(1.00002368 + t*(0.37409196 + t*(0.09678418 + t*(-0.18628806 + t*(0.27886807 + t*(-1.13520398 + t*(1.48851587 + t*(-0.82215223 + t*0.17087277))))))))))"""


@query(f"""WITH x AS (SELECT event_id, (value - 50) / 25 AS x, 1 / (1 + 0.5 * abs((value - 50) / 25)) AS t FROM events)
SELECT event_id, round(CASE WHEN x > 0 THEN {ERF_SQL} ELSE -{ERF_SQL} END, 6) AS erf FROM x""")
def l04_error_function(spark, sf):
    return t(spark, sf, "events", "event_id", "value").select("event_id", F.round(S.erf((F.col("value") - 50) / 25), 6).alias("erf"))


@query(r"""SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_mktsegment) AS low, trim('  ' || c_name || ' ') AS trimmed, ltrim('  ' || c_name) AS left_trimmed,
  substr(c_name, 10, 4) AS cut, replace(c_name, '#', '-') AS replaced, CAST(length(c_name) AS INTEGER) AS len, regexp_replace(c_name, '0+', '0', 'g') AS squeezed FROM customer""")
def l05_string_functions(spark, sf):
    name = F.col("c_name")
    return t(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        "c_custkey", F.upper("c_mktsegment").alias("up"), F.lower("c_mktsegment").alias("low"), F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), name)).alias("left_trimmed"), F.substring(name, 10, 4).alias("cut"), T.swap(name, "#", "-").alias("replaced"),
        F.length(name).alias("len"), F.regexp_replace(name, "0+", "0").alias("squeezed"),
    )


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, 'N/A') AS status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '5-LOW' THEN 'later' END AS when_due FROM orders""")
def l06_null_functions(spark, sf):
    return t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority").select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("N/A")).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "now").when(F.col("o_orderpriority") == "5-LOW", "later").alias("when_due"),
    )


@query("""SELECT o_orderkey, abs(o_custkey - 700) AS distance, round(pow(2, (o_custkey % 10) / 4.0), 6) AS raised, round(log(o_totalprice) / log(2), 6) AS logged,
  round(sqrt(o_totalprice), 6) AS root, round(exp(-o_totalprice / 1e5), 8) AS decay FROM orders""")
def l07_math_functions(spark, sf):
    price = F.col("o_totalprice")
    return t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice").select(
        "o_orderkey", F.abs(F.col("o_custkey") - 700).alias("distance"), F.round(F.pow(F.lit(2.0), (F.col("o_custkey") % 10) / 4.0), 6).alias("raised"),
        F.round(F.log2(price), 6).alias("logged"), F.round(F.sqrt(price), 6).alias("root"), F.round(F.exp(-price / 1e5), 8).alias("decay"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def l08_dates(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "P", "20019999").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate").select(
        "o_orderkey", F.try_to_timestamp(raw, F.lit("yyyyMMdd")).cast("date").alias("day")
    )


# --- E: joins ---------------------------------------------------------------


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def e01_inner(spark, sf):
    return t(spark, sf, "orders", "o_orderkey", "o_custkey").join(t(spark, sf, "customer", "c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey")
def e02_left(spark, sf):
    urgent = t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority").where("o_orderpriority = '1-URGENT'")
    return t(spark, sf, "customer", "c_custkey").join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


FULL_SQL = """SELECT coalesce(a.k, b.k) AS k, a.n AS n_urgent, b.n AS n_low FROM
 (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) a FULL JOIN
 (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1) b ON a.k = b.k"""


@query(FULL_SQL)
def e03_full(spark, sf):
    orders = t(spark, sf, "orders", F.col("o_custkey").alias("k"), "o_orderpriority")
    side = [orders.where(F.col("o_orderpriority") == p).groupBy("k").agg(F.count(F.lit(1)).alias(n)) for p, n in (("1-URGENT", "n_urgent"), ("5-LOW", "n_low"))]
    return side[0].join(side[1], "k", "full")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def e04_semi(spark, sf):
    big = t(spark, sf, "orders", F.col("o_custkey").alias("c_custkey"), "o_totalprice").where("o_totalprice > 400000")
    return t(spark, sf, "customer", "c_custkey").join(big, "c_custkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def e05_anti(spark, sf):
    big = t(spark, sf, "orders", F.col("o_custkey").alias("c_custkey"), "o_totalprice").where("o_totalprice > 400000")
    return t(spark, sf, "customer", "c_custkey").join(big, "c_custkey", "left_anti")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus AS s, CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 3 END AS k FROM orders),
b AS (SELECT s, k, count(*) AS n FROM a GROUP BY ALL) SELECT a.o_orderkey, b.n FROM a JOIN b ON a.s = b.s AND a.k IS NOT DISTINCT FROM b.k""")
def e06_null_safe(spark, sf):
    k = F.col("o_custkey") % 3
    rows = t(spark, sf, "orders", "o_orderkey", F.col("o_orderstatus").alias("s"), F.when(k > 0, k).alias("k"))
    return J.null_safe(rows, rows.groupBy("s", "k").agg(F.count(F.lit(1)).alias("n")), ["s", "k"]).select("o_orderkey", "n")


@query(r"""WITH p AS (SELECT DISTINCT '\' || p_type || '\' || p_brand || '\' || p_name || '\' AS path FROM part), f AS (SELECT DISTINCT '\' || p_type || '\' || p_brand || '\' AS folder FROM part)
SELECT folder, path FROM f JOIN p ON starts_with(path, folder)""")
def e07_prefix(spark, sf):
    part = t(spark, sf, "part", "p_type", "p_brand", "p_name")
    paths = part.select(P.build("p_type", "p_brand", "p_name").alias("path")).distinct()
    folders = part.select(P.build("p_type", "p_brand").alias("folder")).distinct()
    return paths.select("path", F.explode(P.ancestors("path")).alias("folder")).join(folders, "folder").select("folder", "path")


@query("""WITH a AS (SELECT p_partkey, p_type, p_brand, CASE WHEN p_size % 2 = 0 THEN 'Parts+TISSUETYPE+PLATFORM' ELSE 'Parts+PLATFORM+TISSUETYPE' END AS tpl FROM part),
n AS (SELECT p_brand, CASE WHEN tpl LIKE 'Parts+T%' THEN p_type ELSE '' END AS tissue, count(*) AS n FROM a GROUP BY ALL)
SELECT p_partkey, n.n FROM a JOIN n ON a.p_brand = n.p_brand AND CASE WHEN tpl LIKE 'Parts+T%' THEN p_type ELSE '' END = n.tissue""")
def e08_conditional_key(spark, sf):
    template = F.when(F.col("p_size") % 2 == 0, "Parts+TISSUETYPE+PLATFORM").otherwise("Parts+PLATFORM+TISSUETYPE")
    rows = t(spark, sf, "part", "p_partkey", "p_type", "p_brand", "p_size").withColumn("tpl", template)
    cut = F.locate("PLATFORM", F.col("tpl")) + 8
    keyed = rows.withColumn("tissue", J.template_key(F.col("tpl"), cut, "TISSUETYPE", F.col("p_type")))
    nodes = keyed.groupBy("p_brand", "tissue").agg(F.count(F.lit(1)).alias("n"))
    return keyed.join(nodes, ["p_brand", "tissue"]).select("p_partkey", "n")


@query("SELECT o_orderkey, (SELECT count(*) FROM orders) AS n_all, (SELECT max(o_totalprice) FROM orders) AS top FROM orders")
def e09_constants_row(spark, sf):
    orders = t(spark, sf, "orders", "o_orderkey", "o_totalprice")
    constants = orders.agg(F.count(F.lit(1)).alias("n_all"), F.max("o_totalprice").alias("top"))
    return J.with_constants(orders.select("o_orderkey"), constants, ["n_all", "top"])


@query("""WITH f AS (SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, coalesce(first_priority, 'none') AS first_priority FROM customer LEFT JOIN f ON c_custkey = o_custkey""")
def e10_lookup_with_default(spark, sf):
    filled = t(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", F.col("o_orderpriority").alias("first_priority")).where("o_orderstatus = 'F'")
    return J.lookup(t(spark, sf, "customer", "c_custkey"), filled, {"c_custkey": "o_custkey"}, {"first_priority": "none"}, ["o_orderdate", "o_orderkey"])


@query("SELECT c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
def e11_case_insensitive(spark, sf):
    customer = t(spark, sf, "customer", "c_custkey", "c_nationkey").withColumn("site", F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string")))
    return J.no_case(customer, t(spark, sf, "nation"), "site", "n_name").select("c_custkey", "n_regionkey")


STAR_SQL = """SELECT r_name, n_name, s_suppkey % 10 AS supplier_group, p_type, p_brand, o_orderpriority, c_mktsegment, count(*) AS n_rows, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


@query(STAR_SQL)
def e12_star(spark, sf):
    lines = t(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    dims = [
        (t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority"), "l_orderkey", "o_orderkey"),
        (t(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment"), "o_custkey", "c_custkey"),
        (t(spark, sf, "part", "p_partkey", "p_type", "p_brand"), "l_partkey", "p_partkey"),
        (t(spark, sf, "supplier", "s_suppkey"), "l_suppkey", "s_suppkey"),
        (t(spark, sf, "nation"), "c_nationkey", "n_nationkey"), (t(spark, sf, "region"), "n_regionkey", "r_regionkey"),
    ]
    for dim, left, right in dims:
        lines = lines.join(dim, F.col(left) == F.col(right))
    return lines.groupBy(
        "r_name", "n_name", (F.col("s_suppkey") % 10).alias("supplier_group"), "p_type", "p_brand", "o_orderpriority", "c_mktsegment"
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))
