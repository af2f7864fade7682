"""Files whose own lines say how to read them: header lines, column headers and sections.

A large file is read in splits, and no split sees the header. Every line carries its place in the file (first byte of its split, number inside the
split); header lines become one small row per file, which the data lines join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.functions.paths import split_list


def placed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file_path, place and line; places of a file grow from line to line, however the file is split."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), place.alias("place"), F.rtrim("value", F.lit("\r")).alias("line"))


def header_rows(lines: DataFrame, **kinds: Column) -> DataFrame:
    """One row per file with, for each name, the first line that meets its condition."""
    wanted = None
    for test in kinds.values():
        wanted = test if wanted is None else wanted | test
    firsts = [F.min(F.when(test, F.struct("place", "line"))).getField("line").alias(name) for name, test in kinds.items()]
    return lines.where(wanted).groupBy("file_path").agg(*firsts)


def headed_records(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """file_path, place, columns and cells of every record; the first line of a file that is not blank names its columns."""
    full = lines.where(F.trim("line") != "")
    heads = full.groupBy("file_path").agg(F.min(F.struct("place", "line")).alias("__h"))
    both = full.join(heads, "file_path").where(F.col("place") > F.col("__h.place"))
    return both.select("file_path", "place", split_list("__h.line", sep).alias("columns"), split_list("line", sep).alias("cells"))


def section(lines: DataFrame, marker: str) -> DataFrame:
    """The lines of each file that come after its first line ``marker``."""
    starts = lines.where(F.col("line") == marker).groupBy("file_path").agg(F.min("place").alias("__start"))
    return lines.join(starts, "file_path").where(F.col("place") > F.col("__start")).drop("__start")


def text_after(line: Column | str, name: str) -> Column:
    """Text after ``name=`` of a header line."""
    return F.trim(F.substring(line, len(name) + 2, 1 << 30))
