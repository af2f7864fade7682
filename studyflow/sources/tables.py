"""Parquet tables: scans, appends, partition replacement and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyflow.session import settings

# Files that a task keeps open, so that it need not sort its rows by partition value; it sorts what comes after more values than these.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


def read_table(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{base}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of few, small files over the cores before per-row work.

    A scan that already has a split per core (any large table) is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = (df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df).write.mode("append")
    with settings(df.sparkSession, OPEN_FILES):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], rows_per_file: int = 5_000_000) -> None:
    """Replace only the partitions present in ``df`` (delete-and-insert by study)."""
    with settings(df.sparkSession, OPEN_FILES):
        (
            df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(path)
        )


def load_history(df: DataFrame, path: str, study: str, incremental: bool = False) -> None:
    """Landing -> history: replace the loaded studies, or append when incremental."""
    if incremental:
        append(df, path, [study])
    else:
        replace_partitions(df, path, [study])


def load_part(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write one or more parts of deliveries (``keys``: study, delivery, part); a part that comes again replaces itself alone."""
    replace_partitions(df, path, keys)


def current(spark: SparkSession, path: str, study: str, delivery: str) -> DataFrame:
    """The rows of each study's last delivery (the greatest), all its parts; what an earlier delivery brought is out of sight at once."""
    rows = spark.read.parquet(path)
    last = rows.groupBy(study).agg(F.max(delivery).alias(delivery))
    return rows.join(last, [study, delivery], "left_semi")


def drop_superseded(spark: SparkSession, path: str, study: str, delivery: str) -> int:
    """Delete the folders of deliveries that a later one of their study replaced; the number of folders."""
    last = W.partitionBy(study)
    old = spark.read.parquet(path).select(study, delivery).distinct().withColumn("__last", F.max(delivery).over(last)).where(F.col(delivery) < F.col("__last"))
    found = old.collect()
    for row in found:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{study}={row[study]}/{delivery}={row[delivery]}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(found)


def snapshot(tables: dict[str, DataFrame], folder: str) -> None:
    """Write a copy of every table under one snapshot folder."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
