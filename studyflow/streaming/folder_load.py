"""Incremental load of a landing folder: new files only, study by study."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studyflow.session import shared_dir
from studyflow.sources.tables import load_part, replace_partitions

DELIVERY, PART = "delivery", "part"
# Mark of a part that is delivered again.
AGAIN = r"~[0-9]+(?=\.[^.]*$|$)"


def start(
    spark: SparkSession, landing: str, history: str, columns: list[str], study: str = "study_id", name: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None, incremental: bool = True, sep: str = "\t",
) -> StreamingQuery:
    """Process the files that arrived since the last run, then stop.

    File progress is kept under the shared folder (by ``name``, else by the two
    paths), so a run lost with its driver or executors continues where it was.

    ``incremental=False`` loads whole studies by delivery: ``<landing>/<delivery>/<part>``. A file is one part, whatever run or batch finds it. A
    part that comes again (``name~2.txt`` after ``name.txt``) replaces its own rows, and ``tables.current`` shows each study's last delivery with
    all its parts.
    """
    name = name or hashlib.md5(f"{landing}|{history}".encode()).hexdigest()
    schema = ", ".join(f"`{c}` string" for c in columns)
    files = spark.readStream.schema(schema).option("sep", sep).option("header", True)
    files = files.csv(landing) if incremental else files.csv(f"{landing}/*").select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_modification_time").alias("__time"))

    def write(batch: DataFrame, batch_id: int) -> None:
        if incremental:
            rows = transform(batch) if transform else batch
            # a repeated batch replaces its own partition, so nothing is appended twice
            replace_partitions(rows.withColumn("load_batch", F.lit(batch_id)), history, [study, "load_batch"])
        else:
            at = lambda n: F.element_at(F.split("__file", "/"), n)
            named = batch.withColumns({DELIVERY: at(-2), PART: F.regexp_replace(at(-1), AGAIN, "")})
            # of copies of a part that one batch finds, the newest file counts
            newest = named.groupBy(DELIVERY, PART).agg(F.max_by("__file", F.struct("__time", "__file")).alias("__file"))
            parts = named.join(newest, [DELIVERY, PART, "__file"], "left_semi").drop("__file", "__time")
            load_part(transform(parts) if transform else parts, history, [study, DELIVERY, PART])

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{shared_dir(spark)}/progress-{name}")
        .trigger(availableNow=True).start()
    )
