from studyflow.llm import importance as I
from studyflow.llm.shared import settings


def test_only_trusted_texts_are_shuffled(spark, tmp_path):
    spark.createDataFrame([(k, f"text {k} " * 4000) for k in range(60)] + [(None, "no id")], "doc_id long, text string").write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/documents")
    spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] + [(0, 1), (99, 1), (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels")
    texts, good = spark.read.parquet(f"{tmp_path}/documents"), I.trusted_ids(spark.read.parquet(f"{tmp_path}/labels"))
    with settings(spark, I.FILTER_CONF):
        found = I.trusted_texts(texts, good)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(int(r["text"].split()[1]) for r in found.collect()) == list(range(0, 60, 3))
    assert "might_contain" in plan and "BroadcastHashJoin" not in plan
