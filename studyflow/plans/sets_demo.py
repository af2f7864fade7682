"""Queries of aggregation, set, merge and reshape operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.functions import text as T
from studyflow.operators import grouping as G
from studyflow.operators import merge as M
from studyflow.operators import reshape as RS
from studyflow.operators.joins import first_by
from studyflow.operators.numbering import surrogate_ids
from studyflow.plans.data import money, t
from studyflow.plans.registry import query
from studyflow.sources.tables import spread

# --- F: aggregation, sets, merge ---------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_qty, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
  round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY ALL""")
def f01_group_by(spark, sf):
    return t(spark, sf, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"),
    )


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_suppkey")
def f02_count_distinct(spark, sf):
    return t(spark, sf, "lineitem", "l_suppkey", "l_partkey").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"))


@query("""WITH n AS (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
SELECT o_custkey, (n - 1) // 8 + 1 AS part, count(*) AS n_items, string_agg(o_orderpriority, ';' ORDER BY n) AS items FROM n GROUP BY ALL""")
def f03_ordered_concat(spark, sf):
    rows = t(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return G.list_by_key(rows, ["o_custkey"], F.col("o_orderpriority"), ["o_orderdate", "o_orderkey"], ";", 8, F.to_date("o_orderdate"))


@query("SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority, min(o_orderdate)::DATE AS o_orderdate FROM orders GROUP BY o_custkey")
def f04_first_by_order(spark, sf):
    rows = t(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return first_by(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date"))


@query("SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd FROM lineitem GROUP BY l_partkey")
def f05_mean_and_stddev(spark, sf):
    return t(spark, sf, "lineitem", "l_partkey", "l_extendedprice").groupBy("l_partkey").agg(
        (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("mean"), F.round(F.stddev_samp("l_extendedprice"), 4).alias("sd")
    )


@query("SELECT l_partkey, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY l_partkey")
def f06_median(spark, sf):
    out = G.exact_median(t(spark, sf, "lineitem", "l_partkey", "l_extendedprice"), ["l_partkey"], "l_extendedprice")
    return out.withColumn("median", F.round("median", 4))


@query("SELECT l_returnflag, round(median(l_extendedprice), 4) AS median, round(max(l_quantity), 2) AS top FROM lineitem GROUP BY l_returnflag")
def f06_median_of_hot_groups(spark, sf):
    rows = t(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    tops = t(spark, sf, "lineitem", "l_returnflag", "l_quantity").groupBy("l_returnflag").agg(F.round(F.max("l_quantity"), 2).alias("top"))
    return G.exact_median(rows, ["l_returnflag"], "l_extendedprice").withColumn("median", F.round("median", 4)).join(tops, "l_returnflag")


@query("SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 5")
def f07_having(spark, sf):
    return t(spark, sf, "lineitem", "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 5")


@query("""SELECT l_suppkey, max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS max_returned, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS n_open
FROM lineitem GROUP BY l_suppkey""")
def f08_conditional_aggregates(spark, sf):
    return t(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice").groupBy("l_suppkey").agg(
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("max_returned"), F.count_if(F.col("l_linestatus") == "O").alias("n_open")
    )


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def f09_distinct(spark, sf):
    return t(spark, sf, "lineitem", "l_partkey", "l_suppkey").distinct()


@query("SELECT p_brand, p_type, p_name FROM part ORDER BY p_brand DESC, p_type, p_name")
def f11_sort(spark, sf):
    return t(spark, sf, "part", "p_brand", "p_type", "p_name").orderBy(F.desc("p_brand"), "p_type", "p_name")


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, arg_min(l_returnflag, (-n, l_returnflag)) AS flag, max(n) AS flag_rows FROM c GROUP BY l_suppkey""")
def f12_most_frequent(spark, sf):
    return G.most_frequent(t(spark, sf, "lineitem", "l_suppkey", "l_returnflag"), ["l_suppkey"], "l_returnflag", "flag")


@query("SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def f13_union_distinct(spark, sf):
    return t(spark, sf, "orders", F.col("o_custkey").alias("k")).union(t(spark, sf, "customer", F.col("c_custkey").alias("k"))).distinct()


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def f14_except(spark, sf):
    urgent = t(spark, sf, "orders", F.col("o_custkey").alias("k"), "o_orderpriority").where("o_orderpriority = '1-URGENT'").select("k")
    return M.except_distinct(t(spark, sf, "customer", F.col("c_custkey").alias("k")), urgent)


DIFF_SQL = """
old AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 5 <> 0),
new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS price FROM orders WHERE o_orderkey % 3 <> 0),
diff AS (SELECT coalesce(o.k, n.k) AS k, CASE WHEN n.k IS NULL THEN o.status ELSE n.status END AS status, CASE WHEN n.k IS NULL THEN o.price ELSE n.price END AS price,
  CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'deleted' WHEN o.status IS NOT DISTINCT FROM n.status AND o.price IS NOT DISTINCT FROM n.price THEN 'identical' ELSE 'changed' END AS flag
  FROM old o FULL JOIN new n ON o.k = n.k)"""


def old_and_new(spark, sf):
    k = F.col("o_orderkey")
    orders = t(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    old = orders.where(k % 5 != 0).select(k.alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    new = orders.where(k % 3 != 0).select(
        k.alias("k"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("status"), (F.col("o_totalprice") + F.when(k % 11 == 0, 1).otherwise(0)).alias("price")
    )
    return old, new


@query(f"WITH {DIFF_SQL} SELECT * FROM diff")
def f15_merge_diff(spark, sf):
    return M.diff(*old_and_new(spark, sf), ["k"], ["status", "price"])


@query(f"WITH {DIFF_SQL} SELECT k, status, price FROM diff WHERE flag <> 'deleted'")
def f16_apply_flags(spark, sf):
    return M.apply(M.diff(*old_and_new(spark, sf), ["k"], ["status", "price"]))


@query(f"WITH {DIFF_SQL} SELECT coalesce(n.k, o.k) AS k, coalesce(n.status, o.status) AS status, CASE WHEN n.k IS NULL THEN o.price ELSE n.price END AS price FROM old o FULL JOIN new n ON o.k = n.k")
def f17_upsert(spark, sf):
    return M.upsert(*old_and_new(spark, sf), ["k"], ["status", "price"], ["status"])


@query("""SELECT c_custkey, c_name, row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) + 1000 AS patient_num FROM customer""")
def f18_surrogate_ids(spark, sf):
    return surrogate_ids(t(spark, sf, "customer", "c_custkey", "c_name"), ["c_name"], "patient_num", 1000)


# --- G: reshape ---------------------------------------------------------------


@query("""SELECT s_name AS probe, 'S' || l_linenumber AS sample, printf('%.2f', sum(l_quantity)) AS intensity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name, l_linenumber""")
def g01_matrix_unpivot(spark, sf):
    lines = t(spark, sf, "lineitem", "l_suppkey", "l_linenumber", "l_quantity")
    supplier = t(spark, sf, "supplier", "s_suppkey", "s_name")
    names = [f"S{i}" for i in range(1, 8)]
    matrix = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_name").alias("probe")).agg(
        *[money(F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity")))).alias(n) for i, n in enumerate(names, 1)]
    )
    return RS.unpivot_matrix(matrix, ["probe"], names)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS gene, s AS sample, v AS intensity FROM (
  SELECT p_partkey, p_brand, unnest(['GSM1', 'GSM2', 'GSM3']) AS s, unnest([CAST(p_size AS VARCHAR), CASE WHEN p_size % 4 = 0 THEN '' ELSE p_type END, p_name]) AS v FROM part) WHERE v <> ''""")
def g02_assay_lines_unpivot(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_brand", "p_size", "p_type", "p_name")
    lines = part.select(F.concat_ws(
        "\t", F.col("p_partkey").cast("string"), "p_brand", F.col("p_size").cast("string"), F.when(F.col("p_size") % 4 == 0, "").otherwise(F.col("p_type")), "p_name"
    ).alias("line"))
    return RS.unpivot_lines(lines, ["id", "gene", "GSM1", "GSM2", "GSM3"], 2)


@query("""SELECT o_orderkey, o_custkey, antigen, value FROM (SELECT o_orderkey, o_custkey, unnest(['status', 'priority']) AS antigen, unnest([o_orderstatus, o_orderpriority]) AS value FROM orders)""")
def g03_panel_unpivot(spark, sf):
    rows = t(spark, sf, "orders", "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return RS.unpivot_matrix(rows, ["o_orderkey", "o_custkey"], name="antigen", value="value")


@query("""SELECT p_partkey, CAST(pos AS INTEGER) AS pos, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part)""")
def g04_split_to_rows(spark, sf):
    return RS.split_rows(t(spark, sf, "part", "p_partkey", "p_name"), "p_name", " ", "word", "pos").select("p_partkey", "pos", "word")


@query("""SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct FROM (SELECT doc_id, trim(unnest(string_split(text, ' '))) AS word FROM documents) WHERE word <> '' GROUP BY doc_id""")
def g04_split_documents(spark, sf):
    words = RS.split_rows(spread(t(spark, sf, "documents", "doc_id", "text"), "doc_id"), "text", " ", "word")
    sized = words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    return sized.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.count(F.lit(1)).alias("n_distinct"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, k AS measure, v AS amount FROM (SELECT l_orderkey, l_linenumber, l_partkey, unnest(['l_discount', 'l_tax']) AS k, unnest([l_discount, l_tax]) AS v FROM lineitem)""")
def g05_columns_to_rows(spark, sf):
    rows = t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return rows.unpivot(["l_orderkey", "l_linenumber", "l_partkey"], ["l_discount", "l_tax"], "measure", "amount")


@query("""SELECT l_suppkey, max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS A, max(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS N,
  max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS R FROM lineitem GROUP BY l_suppkey""")
def g06_rows_to_columns(spark, sf):
    return RS.rows_to_columns(t(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_extendedprice"), ["l_suppkey"], "l_returnflag", "l_extendedprice", ["A", "N", "R"])


def gene_lists(spark, sf):
    part = t(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.select(
        F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("AFFX-"), "p_brand")).otherwise(F.col("p_brand")).alias("probe"), "p_partkey",
        F.replace("p_name", F.lit(" "), F.lit(" /// ")).alias("genes"),
        F.when(F.col("p_size") % 7 == 0, F.col("p_type")).otherwise(F.concat_ws("///", "p_type", "p_brand")).alias("symbols"),
    )


GENES_SQL = """
g AS (SELECT CASE WHEN p_size % 10 = 0 THEN 'AFFX-' || p_brand ELSE p_brand END AS probe, p_partkey, string_split(p_name, ' ') AS genes,
  CASE WHEN p_size % 7 = 0 THEN [p_type] ELSE [p_type, p_brand] END AS symbols FROM part)"""


@query(f"""WITH {GENES_SQL} SELECT 'result' AS outcome, p_partkey, unnest(genes) AS gene, unnest(symbols) AS symbol FROM g WHERE probe NOT LIKE 'AFFX%' AND len(genes) = len(symbols)
UNION ALL SELECT 'reject', p_partkey, NULL, NULL FROM g WHERE probe NOT LIKE 'AFFX%' AND len(genes) <> len(symbols)
UNION ALL SELECT 'discard', p_partkey, NULL, NULL FROM g WHERE probe LIKE 'AFFX%'""")
def g07_zip_gene_lists(spark, sf):
    result, reject, discard = RS.zip_lists(gene_lists(spark, sf), {"genes": "gene", "symbols": "symbol"}, "///", F.startswith("probe", F.lit("AFFX")))
    none = F.lit(None).cast("string")
    rest = [df.select(F.lit(n).alias("outcome"), "p_partkey", none.alias("gene"), none.alias("symbol")) for n, df in (("reject", reject), ("discard", discard))]
    return result.select(F.lit("result").alias("outcome"), "p_partkey", "gene", "symbol").unionByName(rest[0]).unionByName(rest[1])
