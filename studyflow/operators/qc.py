"""Quality control and audit."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Column
from pyspark.sql import functions as F

from studyflow.functions import text as T
from studyflow.operators.numbering import number_rows

TOLERANCE = 0.001


def agree(left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    """Numbers within the tolerance, anything else exactly equal."""
    a, b = T.to_number(left), T.to_number(right)
    return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) < tolerance).otherwise(F.coalesce(left == right, F.lit(False)))


def compare(
    source: DataFrame, target: DataFrame, keys: list[str], value: str, tolerance: float = TOLERANCE, slice_by: Column | None = None
) -> DataFrame:
    """Source values against the warehouse, the i-th of a key with the i-th of that key.

    Blank and ``.`` source values are ignored; ``state`` is equal, different or missing.
    """
    def ranked(df: DataFrame, out: str) -> DataFrame:
        held = df.where(~F.coalesce(T.strip(F.col(value)), F.lit("")).isin("", ".")).select(*keys, F.col(value).alias(out), T.to_number(value).alias("__num"))
        return number_rows(held, ["__num", out], keys, slice_by, "__i").drop("__num")

    both = ranked(source, "source_value").join(ranked(target, "target_value"), [*keys, "__i"], "left")
    state = F.when(F.col("target_value").isNull(), "missing").when(agree(F.col("source_value"), F.col("target_value"), tolerance), "equal").otherwise("different")
    return both.drop("__i").withColumn("state", state)


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], value: str, tolerance: float = TOLERANCE) -> DataFrame:
    """The same for values unique per key: one join, no ranking."""
    held = source.where(~F.coalesce(T.strip(F.col(value)), F.lit("")).isin("", ".")).select(*keys, F.col(value).alias("source_value"))
    both = held.join(target.select(*keys, F.col(value).alias("target_value")), keys, "left")
    state = F.when(F.col("target_value").isNull(), "missing").when(agree(F.col("source_value"), F.col("target_value"), tolerance), "equal").otherwise("different")
    return both.withColumn("state", state)


def state_counts(compared: DataFrame) -> DataFrame:
    return compared.groupBy("state").agg(F.count(F.lit(1)).alias("n_values"))


def column_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls / blanks and distinct values of curated columns, in one pass over the distinct pairs."""
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), T.blank_to_null(F.col(c).cast("string")).alias("v")) for c in columns
    ])).alias("c")).select("c.*")
    sized = cells.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return sized.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_blank"),
        F.count("v").alias("n_distinct"),
    )


def step_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """Rows of every step as one lazy report."""
    rows = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(i + 1).alias("step"), F.lit(name).alias("step_name"), "records") for i, (name, df) in enumerate(steps.items())]
    return reduce(DataFrame.unionByName, rows)


def read_dropped(df: DataFrame, kept: Column, file: str) -> DataFrame:
    """Rows read and dropped per file."""
    ok = F.coalesce(kept, F.lit(False))
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("n_read"), F.count_if(~ok).alias("n_dropped"))


class AuditTrail:
    """Counts and seconds of the steps of a job, taken while the steps are written."""

    SCHEMA = "job string, step int, step_name string, records long, status string, seconds double"

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job, self.rows, self.last = spark, job, [], time.monotonic()

    def write(self, name: str, df: DataFrame, path: str, **options) -> DataFrame:
        """Write a step and record its rows without a second pass."""
        seen = Observation()
        status = "Done"
        try:
            df.observe(seen, F.count(F.lit(1)).alias("records")).write.mode("overwrite").options(**options).parquet(path)
            records = seen.get["records"]
        except Exception:
            status, records = "FAIL", None
            raise
        finally:
            now = time.monotonic()
            self.rows.append((self.job, len(self.rows) + 1, name, records, status, round(now - self.last, 3)))
            self.last = now
        return self.spark.read.parquet(path)

    def report(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, self.SCHEMA)


def run_report(errors: DataFrame, invalid_terms: DataFrame, audit: DataFrame) -> DataFrame:
    """One text line per audit step, error and invalid term of a run."""
    return (
        audit.select(F.lit("AUDIT").alias("section"), F.concat_ws(" ", "step_name", "records").alias("line"))
        .unionByName(errors.select(F.lit("ERROR").alias("section"), F.col("message").alias("line")))
        .unionByName(invalid_terms.select(F.lit("INVALID_TERM").alias("section"), F.concat_ws(": ", "category", "term").alias("line")))
    )
