"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Run-time re-planning does the partition sizing: shuffles begin with many
# small partitions, which are merged (or split, when skewed) at run time.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "4096",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "studyflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the jobs that run inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is made only where the session names none and the driver
    is the only machine (tests); on a cluster the setting must be there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="studyflow-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several results share and read it back (column-pruned by each of them)."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a work path made here, once nothing reads it any more."""
    if not path.startswith(shared_dir(spark)):
        raise ValueError(f"{path} is not in the work folder")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
