import uuid

from pyspark.sql import functions as F

from frame_rows import rows
from studyflow.sources import files as FI
from studyflow.sources import tables as TB
from studyflow.streaming import folder_load


def test_delimited_round_trip_with_comments(spark, tmp_path):
    (tmp_path / "a.txt").write_text("#c\nID\tX\n1\ta b\n2\t\n")
    assert rows(FI.read_delimited(spark, str(tmp_path), comment="#")) == [("1", "a b"), ("2", None)]


def test_names_and_routes(spark):
    df = spark.createDataFrame([("file:/x/Top/Study/ExpressionData/GSE1_GPL570_R.txt",)], "file_path string")
    row = FI.folder_route(FI.describe_names(df)).first()
    assert (row["data_type"], row["platform"], row["kind"], row["node"]) == ("R", "GPL570", "ExpressionData", "\\Top\\Study\\")


def test_column_counts(spark):
    lines = spark.createDataFrame([("p1\t1\t2",), ("p2\t1",), ("p1\t3\t4",)], "line string")
    out = {r["n_columns"]: (r["n_rows"], r["n_probes"], r["valid"]) for r in FI.column_count_report(lines, "ID\ta\tb").collect()}
    assert out == {3: (2, 1, True), 2: (1, 1, False)}


def test_partition_replace_touches_only_its_studies(spark, tmp_path):
    path = str(tmp_path / "h")
    first = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3)], "study_id string, v int")
    TB.load_history(first, path, "study_id")
    TB.load_history(spark.createDataFrame([("B", 9)], "study_id string, v int"), path, "study_id")
    TB.load_history(spark.createDataFrame([("B", 9)], "study_id string, v int"), path, "study_id")  # a reload changes nothing
    assert rows(spark.read.parquet(path).select("study_id", "v")) == [("A", 1), ("B", 9)]
    TB.load_history(spark.createDataFrame([("A", 4)], "study_id string, v int"), path, "study_id", incremental=True)
    assert spark.read.parquet(path).where("study_id = 'A'").count() == 2


def test_rejects_go_to_the_side(spark, tmp_path):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    FI.write_with_rejects(df, F.col("v") == "1", str(tmp_path / "ok"), str(tmp_path / "bad"))
    assert FI.read_delimited(spark, str(tmp_path / "ok")).count() == 1 and FI.read_delimited(spark, str(tmp_path / "bad"), ["v"]).count() == 2


def test_folder_load_takes_new_files_once(spark, tmp_path):
    landing, history, name = tmp_path / "in", str(tmp_path / "out"), uuid.uuid4().hex
    landing.mkdir()

    def run():
        folder_load.start(spark, str(landing), history, ["study_id", "v"], name=name, transform=lambda b: b.where("v <> 'drop'")).awaitTermination()
        return rows(spark.read.parquet(history).select("study_id", "v"))

    (landing / "1.txt").write_text("study_id\tv\nA\t1\nA\tdrop\n")
    assert run() == [("A", "1")]
    (landing / "2.txt").write_text("study_id\tv\nA\t2\nB\t3\n")
    assert run() == [("A", "1"), ("A", "2"), ("B", "3")]
    assert run() == [("A", "1"), ("A", "2"), ("B", "3")]


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 50)
    assert TB.spread(wide) is wide and TB.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_partitions_are_written_without_sorting(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        seen.append(int(spark.conf.get(name)))
        return write(self, path, *args, **options)

    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    df = spark.range(400).select(F.when(F.col("id") % 40 > 0, F.col("id") % 40).alias("study_id"), "id")
    TB.replace_partitions(df, str(tmp_path / "h"), ["study_id"], 3)
    TB.append(df.where("study_id = 1"), str(tmp_path / "h"), ["study_id"])
    assert min(seen) > 0 and spark.conf.get(name) == before
    # more studies than open files
    got = spark.read.parquet(str(tmp_path / "h")).groupBy("study_id").count().collect()
    assert {r["study_id"]: r["count"] for r in got} == {**{k: 10 for k in range(2, 40)}, 1: 20, None: 10}
