"""Queries of quality control, audit and the incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyflow.operators import qc as Q
from studyflow.plans.data import money, t
from studyflow.plans.registry import query
from studyflow.session import work_path
from studyflow.sources import files as FI
from studyflow.sources import tables as TB
from studyflow.streaming import folder_load


def source_and_target(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders", F.col("o_custkey").alias("subject"), F.col("o_orderkey"), F.col("o_orderpriority").alias("property"), "o_totalprice", "o_orderstatus")
    value = F.when(k % 13 == 0, ".").when(k % 3 == 0, F.col("o_orderstatus")).otherwise(money(F.col("o_totalprice")))
    source = rows.select("subject", "o_orderkey", "property", value.alias("value"))
    changed = F.when(k % 3 == 0, F.when(k % 9 == 0, "Z").otherwise(F.col("o_orderstatus"))).otherwise(
        F.format_string("%.4f", F.col("o_totalprice") + F.when(k % 5 == 0, 1).when(k % 7 == 0, 0.0004).otherwise(0))
    )
    target = rows.where(k % 11 != 0).select("subject", "o_orderkey", "property", changed.alias("value"))
    return source, target


STATE_SQL = """CASE WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 9 = 0 THEN 'different' ELSE 'equal' END WHEN o_orderkey % 5 = 0 THEN 'different' ELSE 'equal' END"""


@query(f"""SELECT o_orderkey, {STATE_SQL} AS state FROM orders WHERE o_orderkey % 13 <> 0""")
def j01_reconcile_values(spark, sf):
    source, target = source_and_target(spark, sf)
    return Q.reconcile(source, target, ["o_orderkey", "subject", "property"], "value").select("o_orderkey", "state")


@query("""WITH s AS (SELECT o_custkey AS subject, o_totalprice AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS i FROM orders),
w AS (SELECT o_custkey AS subject, o_totalprice AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS i FROM orders WHERE o_orderkey % 10 <> 0)
SELECT state, count(*) AS n_values FROM (SELECT CASE WHEN w.v IS NULL THEN 'missing' WHEN abs(s.v - w.v) < 0.001 THEN 'equal' ELSE 'different' END AS state FROM s LEFT JOIN w USING (subject, i)) GROUP BY 1""")
def j01_compare_repeated_values(spark, sf):
    rows = t(spark, sf, "orders", "o_orderkey", F.col("o_custkey").alias("subject"), money(F.col("o_totalprice")).alias("value"))
    return Q.state_counts(Q.compare(rows, rows.where("o_orderkey % 10 <> 0"), ["subject"], "value"))


@query("""WITH v AS (SELECT l_partkey AS probe, l_suppkey AS sample, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL)
SELECT CASE WHEN sample % 10 = 0 THEN 'missing' WHEN probe % 10 = 0 THEN 'different' ELSE 'equal' END AS state, count(*) AS n_values FROM v GROUP BY 1""")
def j02_reconcile_intensities(spark, sf):
    values = t(spark, sf, "lineitem", F.col("l_partkey").alias("probe"), F.col("l_suppkey").alias("sample"), "l_extendedprice").groupBy("probe", "sample").agg(F.max("l_extendedprice").alias("v"))
    source = values.select("probe", "sample", money(F.col("v")).alias("value"))
    target = values.where("sample % 10 <> 0").select("probe", "sample", money(F.col("v") + F.when(F.col("probe") % 10 == 0, 1).otherwise(0)).alias("value"))
    return Q.state_counts(Q.reconcile(source, target, ["probe", "sample"], "value"))


@query("""WITH c AS (SELECT unnest(['o_custkey', 'o_orderstatus', 'o_orderpriority']) AS column_name, unnest([CAST(o_custkey AS VARCHAR), CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, o_orderpriority]) AS v FROM orders)
SELECT column_name, count(*) AS n_rows, count(*) - count(v) AS n_blank, count(DISTINCT v) AS n_distinct FROM c GROUP BY 1""")
def j03_column_report(spark, sf):
    rows = t(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(" "))
    return Q.column_report(rows, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("""SELECT 1 AS step, 'read' AS step_name, count(*) AS records FROM orders UNION ALL SELECT 2, 'open', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 3, 'subjects', count(DISTINCT o_custkey) FROM orders""")
def j04_step_counts(spark, sf):
    rows = t(spark, sf, "orders", "o_custkey", "o_orderstatus")
    return Q.step_counts({"read": rows, "open": rows.where("o_orderstatus = 'O'"), "subjects": rows.select("o_custkey").distinct()})


@query("SELECT o_orderpriority || '.txt' AS file_name, count(*) AS n_read, count(*) FILTER (o_orderstatus = 'P') AS n_dropped FROM orders GROUP BY 1")
def j04_read_and_dropped(spark, sf):
    rows = t(spark, sf, "orders", F.concat("o_orderpriority", F.lit(".txt")).alias("file_name"), "o_orderstatus")
    return Q.read_dropped(rows, F.col("o_orderstatus") != "P", "file_name")


@query("""SELECT 'load' AS job, 1 AS step, 'orders' AS step_name, count(*) AS records, 'Done' AS status FROM orders UNION ALL SELECT 'load', 2, 'open', count(*), 'Done' FROM orders WHERE o_orderstatus = 'O'""")
def j04_audit_trail(spark, sf):
    trail = Q.AuditTrail(spark, "load")
    folder = work_path(spark, "audited")
    rows = trail.write("orders", t(spark, sf, "orders"), folder + "/orders")
    trail.write("open", rows.where("o_orderstatus = 'O'"), folder + "/open")
    return trail.report().drop("seconds")


@query("""SELECT 'AUDIT' AS section, 'read ' || count(*) AS line FROM orders UNION ALL SELECT 'ERROR', 'duplicate order of subject ' || o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL SELECT 'INVALID_TERM', 'platform: ' || p_type FROM (SELECT DISTINCT p_type FROM part)""")
def j05_run_report(spark, sf):
    orders = t(spark, sf, "orders", "o_custkey")
    errors = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.concat(F.lit("duplicate order of subject "), F.col("o_custkey").cast("string")).alias("message"))
    terms = t(spark, sf, "part", F.lit("platform").alias("category"), F.col("p_type").alias("term")).distinct()
    return Q.run_report(errors, terms, Q.step_counts({"read": orders}))


@query("""SELECT o_orderstatus AS study_id, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'd2' ELSE 'd1' END AS delivery, CASE WHEN o_orderstatus = 'F' THEN 'all.txt' ELSE 'p' || o_orderkey % 3 || '.txt' END AS part
FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0""")
def c29_full_load_by_delivery(spark, sf):
    """Parts of one delivery over two runs, one of them sent twice; then one study comes anew and replaces what it was."""
    landing, history = work_path(spark, "delivered"), work_path(spark, "kept")
    rows = t(spark, sf, "orders", "o_orderkey", F.col("o_orderstatus").alias("study_id"))
    part = lambda k: rows.where(F.col("o_orderkey") % 3 == k)
    runs = [[("d1", "p0", part(0)), ("d1", "p1", part(1).where("o_orderkey % 5 = 0"))], [("d1", "p2", part(2)), ("d1", "p1~2", part(1))], [("d2", "all", rows.where("study_id = 'F' and o_orderkey % 2 = 0"))]]
    for files in runs:
        for delivery, name, frame in files:
            deliver(frame.select(F.col("o_orderkey").cast("string"), "study_id"), landing, delivery, name + ".txt")
        folder_load.start(spark, landing, history, ["o_orderkey", "study_id"], name=landing.rsplit("-", 1)[1], incremental=False).awaitTermination()
    return TB.current(spark, history, "study_id", folder_load.DELIVERY)


def deliver(frame, landing, delivery, name):
    """One file of a given name: written beside the landing folder, then moved into it whole."""
    spark = frame.sparkSession
    aside = work_path(spark, "aside")
    frame.coalesce(1).write.option("sep", "\t").option("header", True).csv(aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    written = [f.getPath() for f in store.listStatus(path(aside)) if f.getPath().getName().startswith("part-")]
    store.mkdirs(path(f"{landing}/{delivery}"))
    store.rename(written[0], path(f"{landing}/{delivery}/{name}"))


@query("SELECT o_orderstatus AS study_id, count(*) + count(*) FILTER (o_orderkey % 2 = 0) AS n_rows FROM orders GROUP BY 1")
def c29_incremental_load(spark, sf):
    landing, history = work_path(spark, "arriving"), work_path(spark, "arrived")
    rows = t(spark, sf, "orders", F.col("o_orderkey").cast("string"), F.col("o_orderstatus").alias("study_id"))
    name = landing.rsplit("-", 1)[1]
    for batch in (rows, rows.where("o_orderkey % 2 = 0")):
        batch.write.mode("append").option("sep", "\t").option("header", True).csv(landing)
        folder_load.start(spark, landing, history, ["o_orderkey", "study_id"], name=name).awaitTermination()
    return spark.read.parquet(history).groupBy("study_id").agg(F.count(F.lit(1)).alias("n_rows"))
