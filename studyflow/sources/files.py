"""Delimited-file scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.functions.paths import nth, split_list

# Value-type letter of an expression file name
# (raw, log, transformed, z-score) and the name patterns it is read from.
MATRIX_NAME = r"^(.+?)_([RLTZ])\.[^.]+$"
PLATFORM_NAME = r"(GPL[0-9]+)"
# end of fixed values


def read_delimited(
    spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = "\t", header: bool = True,
    comment: str | None = None,
) -> DataFrame:
    """All-string scan of delimited files; an explicit column list avoids a schema pass."""
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if comment:
        reader = reader.option("comment", comment)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """Text lines (or records ended by ``line_sep``) with the file they came from."""
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("file_path"))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def describe_names(files: DataFrame, path: str = "file_path") -> DataFrame:
    """File name, study part, value-type letter and platform read from the name."""
    name = file_name(F.col(path))
    return files.withColumns({
        "file_name": name,
        "study": F.regexp_extract(name, MATRIX_NAME, 1),
        "data_type": F.regexp_extract(name, MATRIX_NAME, 2),
        "platform": F.regexp_extract(name, PLATFORM_NAME, 1),
    })


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File listing by name pattern, without reading the contents."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .load(path).select(F.col("path").alias("file_path"), F.col("length").alias("bytes"))
    )


def folder_route(files: DataFrame, path: str = "file_path", kind_level: int = -2) -> DataFrame:
    """Kind of a file from its folder, and its tree node from the folders between root and kind."""
    pieces = split_list(path, "/")
    return files.withColumns({
        "kind": F.try_element_at(pieces, F.lit(kind_level)),
        "node": F.concat(F.lit("\\"), F.try_element_at(pieces, F.lit(kind_level - 2)), F.lit("\\"), F.try_element_at(pieces, F.lit(kind_level - 1)), F.lit("\\")),
    })


def column_count_report(lines: DataFrame, header: Column | str, line: str = "line", sep: str = "\t") -> DataFrame:
    """Rows per column count against the header's count, with the number of distinct probes."""
    head = F.lit(header) if isinstance(header, str) else header
    counted = lines.select(
        F.size(split_list(line, sep)).alias("n_columns"),
        F.size(split_list(head, sep)).alias("expected_columns"),
        nth(line, 1, sep).alias("probe"),
    )
    return counted.groupBy("expected_columns", "n_columns").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("probe").alias("n_probes")
    ).withColumn("valid", F.col("n_columns") == F.col("expected_columns"))


def write_text(df: DataFrame, path: str, sep: str = "\t", header: bool = True) -> None:
    writer = df.write.mode("overwrite").option("sep", sep).option("header", header)
    if len(df.columns) == 1:
        # an unquoted null alone would be a blank line, which scans skip
        writer = writer.option("nullValue", '""')
    writer.csv(path)


def write_with_rejects(df: DataFrame, valid: Column, path: str, rejects_path: str) -> None:
    """Valid rows to one folder, all others to the rejects folder."""
    ok = F.coalesce(valid, F.lit(False))
    write_text(df.where(ok), path)
    write_text(df.where(~ok), rejects_path)
