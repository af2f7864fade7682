"""Exact deduplication as a stateful stream, in DataFrame functions only.

A stream of fingerprints updates a keyed state that is kept on disk (RocksDB) and never expires: for each digest the greatest document id,
the locator of that row's content and the number of rows. A hit is checked on its full bytes: the least and the greatest text of a digest
must be the same; should two texts share a digest, their rows are grouped by the text itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import documents, settings
from studyflow.session import staged, work_path

# Bytes of new files that one micro-batch takes.
BATCH_BYTES = 256 * 2**30
SALTS = 16

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    # A store is closed when its task ends; with few, large batches it is seldom opened again.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (SHA-256), n_bytes and locator (file of the row, empty if it comes from none); a null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), F.input_file_name().alias("locator"))


def remember(stream: DataFrame, work: str | None = None) -> DataFrame:
    """Run a stream of fingerprints over what there is now and return the state: one row for each digest.

    ``work`` names the folder of the stream's progress and state; given again, a later call takes only new files and keeps what it knew.
    """
    spark = stream.sparkSession
    work = work or work_path(spark, "dedup")
    updates = f"{work}/updates"
    state = stream.groupBy("digest", "n_bytes").agg(F.max("doc_id").alias("keep_id"), F.max_by("locator", "doc_id").alias("locator"), F.count(F.lit(1)).alias("group_size"))
    empty = spark.createDataFrame([], state.schema)
    empty.write.mode("append").parquet(updates)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch-{number:09d}")

    with settings(spark, STATE_CONF):
        query = state.writeStream.outputMode("update").option("checkpointLocation", f"{work}/progress").trigger(availableNow=True).foreachBatch(save).start()
        query.awaitTermination()
    rows = spark.read.schema(state.schema).option("recursiveFileLookup", "true").parquet(updates)
    # Ids and sizes only grow, so the greatest of the updates is the last state.
    return rows.groupBy("digest", "n_bytes").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))


def decide(docs: DataFrame, state: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document, after the check of full bytes.

    Rows that repeat with the same id and text give one row (all count in group_size). Rows with the same id and other text are other documents.
    A null id is never kept in place of a known one. No rows give none.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    state = staged(state, "dedup-state")
    prints = fingerprints(docs, id_col, text_col)
    # A digest's rows are dealt over SALTS tasks, which each pass on one row.
    whole = docs.select(F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"), text, F.pmod(F.xxhash64(id_col), F.lit(SALTS)).alias("salt"))
    hits = state.where("group_size > 1").select("digest", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    clash = staged(whole.join(hits, ["digest", "salt"], "left_semi").groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("digest"), "dedup-clash")
    thin = prints.groupBy("doc_id", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("n")).drop("n")
    shown = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    result = thin.join(state, ["digest", "n_bytes"]).select(*shown)
    if clash.isEmpty():
        return result
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"), text).join(clash, "digest", "left_semi")
    by_text = rows.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    apart = rows.distinct().join(by_text, "text").select(*shown)
    return thin.join(clash, "digest", "left_anti").join(state, ["digest", "n_bytes"]).select(*shown).unionByName(apart)


def stream_of(spark: SparkSession, path: str, schema, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The Parquet file or files at ``path`` as a stream. The last letter is a class of its own: a stream takes a lone file only by a pattern."""
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(f"{path[:-1]}[{path[-1]}]")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decide`` for any frame: its fingerprints are written once and streamed into a new state."""
    path = work_path(docs.sparkSession, "fingerprints")
    fingerprints(docs, id_col, text_col).write.parquet(path)
    thin = docs.sparkSession.read.parquet(path)
    return decide(docs, remember(stream_of(docs.sparkSession, path, thin.schema)), id_col, text_col)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, each once, with all their columns."""
    kept = copies(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    digest = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    rows = docs.join(kept, docs[id_col].eqNullSafe(kept["__id"]) & (digest == kept["__sha"]))
    return rows.dropDuplicates(["__id", "__sha"]).select(*[docs[c] for c in docs.columns])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    stream = fingerprints(stream_of(spark, f"{sf_dir}/documents.parquet", docs.schema))
    return decide(docs, remember(stream))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
