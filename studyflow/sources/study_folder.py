"""Load of whole study folders: list the paths, sort the files by kind, read every kind in one job, remember what was loaded.

``<root>/<node>/…/<study>/<kind folder>/<file>.txt``: the kind is the name of the file's folder, the study the folder above it, the tree node the
folders between root and kind folder. Listing reads no contents.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.functions.paths import split_list
from studyflow.sources.files import MATRIX_NAME, file_name, list_files
from studyflow.sources.headed import headed_records, placed_lines

# Folders of a study, with the kind of their files, and the marks of files that are not to be loaded.
KIND_FOLDERS = {"ClinicalData": "clinical", "ExpressionData": "expression", "RBMData": "antigen", "SampleMap": "samples", "MetaData": "metadata"}
NOT_LOADED = ("_DONE_", "_FAIL_", "_DISABLED_", ".")
# end of fixed values

SAMPLE_COLUMNS = ["study_id", "site_id", "subject_id", "sample_cd", "platform", "tissue_type", "attribute_1", "attribute_2", "category_cd"]
LOADED = "file_path string, bytes long, kind string, study string, node string, n_rows long, load long"

Reader = Callable[[DataFrame], DataFrame]


def study_files(spark: SparkSession, root: str) -> DataFrame:
    """file_path, bytes, kind, study and node of every file that is to be loaded."""
    files = list_files(spark, root, "*.txt")
    below = split_list(F.substring_index("file_path", re.sub("^[a-z0-9]+:/*", "/", root.rstrip("/")) + "/", -1), "/")
    folder = F.regexp_replace(F.try_element_at(below, F.lit(-2)), "ToUpload$", "")
    kinds = F.create_map(*[F.lit(x) for pair in KIND_FOLDERS.items() for x in pair])
    node = F.concat(F.lit("\\"), F.concat_ws("\\", F.slice(below, F.lit(1), F.greatest(F.size(below) - 2, F.lit(0)))), F.lit("\\"))
    named = files.withColumns({"kind": kinds[folder], "study": F.try_element_at(below, F.lit(-3)), "node": node, "__name": file_name(F.col("file_path"))})
    marked = F.lit(False)
    for mark in NOT_LOADED:
        marked = marked | F.startswith("__name", F.lit(mark))
    return named.where(F.col("kind").isNotNull() & ~marked).drop("__name")


def cells_of(records: DataFrame) -> DataFrame:
    """item (first cell), column (its name) and value of every further cell of headed records."""
    long = records.select("file_path", F.try_element_at("cells", F.lit(1)).alias("item"), "columns", F.posexplode("cells").alias("at", "value")).where("at > 0")
    return long.select("file_path", "item", F.get("columns", F.col("at")).alias("column"), "value")


def read_clinical(lines: DataFrame) -> DataFrame:
    """Subject, column and value of wide clinical files."""
    return cells_of(headed_records(lines))


def read_expression(lines: DataFrame) -> DataFrame:
    """Probe, sample and value of matrices, without cells that are no number; the value type comes from the file name."""
    kind = F.nullif(F.regexp_extract(file_name(F.col("file_path")), MATRIX_NAME, 2), F.lit(""))
    return cells_of(headed_records(lines)).where(F.col("value").try_cast("double").isNotNull()).withColumn("data_type", kind)


def read_samples(lines: DataFrame) -> DataFrame:
    """Sample, column and value of sample maps, which have no header and columns by position."""
    cells = split_list("line", "\t")
    long = lines.where(F.trim("line") != "").select("file_path", F.get(cells, F.lit(SAMPLE_COLUMNS.index("sample_cd"))).alias("item"), F.posexplode(cells).alias("at", "value"))
    return long.select("file_path", "item", F.get(F.array(*[F.lit(c) for c in SAMPLE_COLUMNS]), F.col("at")).alias("column"), "value").where("value <> ''")


READERS: dict[str, Reader] = {"clinical": read_clinical, "antigen": read_clinical, "expression": read_expression, "samples": read_samples, "metadata": read_clinical}


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """What was loaded so far, file by file."""
    try:
        return spark.read.schema(LOADED).parquet(f"{target}/manifest")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LOADED)


def load(spark: SparkSession, root: str, target: str, readers: dict[str, Reader] | None = None) -> DataFrame:
    """Load the files under ``root`` that no earlier call loaded; their manifest rows come back.

    One scan and one write for each kind, whatever the number of files; the driver holds their paths, as for any scan. Rows go to
    ``<target>/<kind>/load=<n>``. The manifest is written last: a call that dies is repeated under the same number and replaces its own rows.
    A file that changed in size is a new one. A file without records is in the manifest with no rows.
    """
    readers = readers or READERS
    known = manifest(spark, target)
    number = (known.agg(F.max("load")).first()[0] or 0) + 1
    fresh = study_files(spark, root).join(known.select("file_path", "bytes"), ["file_path", "bytes"], "left_anti").where(F.col("kind").isin(list(readers)))
    listed = fresh.collect()
    counts = []
    for kind in sorted({r["kind"] for r in listed}):
        rows = readers[kind](placed_lines(spark, [r["file_path"] for r in listed if r["kind"] == kind]))
        path = f"{target}/{kind}/load={number}"
        rows.write.mode("overwrite").parquet(path)
        counts.append(spark.read.parquet(path).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows")))
    done = spark.createDataFrame(listed, fresh.schema)
    if counts:
        whole = counts[0]
        for more in counts[1:]:
            whole = whole.unionByName(more)
        done = done.join(whole, "file_path", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))
    else:
        done = done.withColumn("n_rows", F.lit(0).cast("long"))
    done = done.withColumn("load", F.lit(number).cast("long")).select("file_path", "bytes", "kind", "study", "node", "n_rows", "load")
    if listed:
        done.coalesce(1).write.mode("append").parquet(f"{target}/manifest")
    return spark.createDataFrame(done.collect(), LOADED)


def loaded_rows(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """All rows of a kind that finished loads brought, with study, node and load."""
    known = manifest(spark, target).where(F.col("kind") == kind).select("file_path", "study", "node", "load")
    return spark.read.parquet(f"{target}/{kind}").join(known, ["file_path", "load"])
