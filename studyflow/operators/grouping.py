"""Aggregations the warehouse needs beyond the built-in ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyflow.operators.numbering import number_rows
from studyflow.session import cut


def list_by_key(
    df: DataFrame,
    keys: list[str],
    value: Column,
    order: list[str],
    sep: str = ";",
    part_size: int = 1000,
    slice_by: Column | None = None,
    out: str = "items",
) -> DataFrame:
    """Ordered string concatenation per key, in consecutive parts of ``part_size`` items.

    Part 1, 2, … of a key joined by ``sep`` are its whole list; no task ever
    holds more than one part of a hot key.
    """
    numbered = number_rows(df.withColumn("__v", value), order, keys, slice_by, "__n")
    chunk = (F.floor((F.col("__n") - 1) / part_size) + 1).cast("long")
    packed = numbered.groupBy(*keys, chunk.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("__n", "__v"))).alias("__l"), F.count("__v").alias("n_items")
    )
    return packed.select(*keys, "part", "n_items", F.array_join(F.col("__l.__v"), sep).alias(out))


def record_concat(df: DataFrame, keys: list[str], value: Column, order: Column, sep: str, out: str) -> DataFrame:
    """Ordered concatenation inside one source record (bounded by its column count)."""
    items = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(items, lambda s: s["v"]), sep).alias(out))


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median", extra: dict[str, Column] | None = None) -> DataFrame:
    """Exact median per group (mean of the middle two), with further aggregates of the same rows.

    The counts of each distinct value are range partitioned on (keys, value) and
    pinned by a checkpoint. A running count is the total of earlier slices plus
    a window inside the slice, so a group of any size is spread over as many
    tasks as its distinct values need, and only its middle values are kept.
    """
    # one struct names the group: never null itself
    rows = df.where(F.col(value).isNotNull()).withColumn("__key", F.struct(F.lit(0).alias("__0"), *keys))
    counts = rows.groupBy("__key", F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    slices = cut(counts.repartitionByRange("__key", "__v").withColumn("__slice", F.spark_partition_id()))
    group = W.partitionBy("__key")
    totals = slices.groupBy("__key", "__slice").agg(F.sum("__n").alias("__in")).select(
        "__key", "__slice", "__in", F.sum("__in").over(group).alias("__all"),
        F.coalesce(F.sum("__in").over(group.orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
    )
    low, high = F.expr("(__all + 1) div 2"), F.expr("__all div 2 + 1")
    wanted = totals.where((F.col("__before") < high) & (F.col("__before") + F.col("__in") >= low)).drop("__in")
    inside = W.partitionBy("__key", "__slice").orderBy("__v").rowsBetween(W.unboundedPreceding, 0)
    # The window comes first: its order is that of the join too, so a task sorts its values once.
    running = slices.withColumn("__in_slice", F.sum("__n").over(inside)).join(wanted, ["__key", "__slice"])
    running = running.withColumn("__upto", F.col("__before") + F.col("__in_slice"))
    middle = running.where((F.col("__upto") >= low) & (F.col("__upto") - F.col("__n") < high))
    ends = middle.groupBy("__key").agg(F.min("__v").cast("double").alias("__low"), F.max("__v").cast("double").alias("__high"))
    result = ends.withColumn(out, F.when(F.col("__low") == F.col("__high"), F.col("__low")).otherwise(F.col("__low") * 0.5 + F.col("__high") * 0.5))
    if extra:
        result = result.join(rows.groupBy("__key").agg(*[c.alias(n) for n, c in extra.items()]), "__key")
    return result.select(*[F.col("__key").getField(k).alias(k) for k in keys], out, *(extra or {}))


def most_frequent(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The most frequent value per key; the smallest one on a tie."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct((-F.col("__n")).alias("a"), F.col(value).alias("b"))).alias(out),
        F.max("__n").alias(f"{out}_rows"),
    )


def reduce_duplicates(df: DataFrame, keys: list[str], value: str, rule: str, record: str) -> DataFrame:
    """MIN / MAX / MEAN of duplicated readings, keeping the lowest record number.

    The mean of a decimal column is its exact sum over its count.
    """
    exact = df.schema[value].dataType.typeName() == "decimal"
    mean = F.sum(value).cast("double") / F.count(value) if exact else F.avg(value)
    reduced = {"MIN": F.min(value), "MAX": F.max(value), "MEAN": mean}[rule]
    return df.groupBy(*keys).agg(reduced.alias(value), F.min(record).alias(record))
