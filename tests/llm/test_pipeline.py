from collections import Counter

import corpus_pipeline
from studyflow.llm import exact_dedup, packing, pii, quality
from studyflow.llm.queries import ORACLES, QUERIES
from tests.llm.test_dedup import brute_near

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLES) <= set(QUERIES)


def test_queries_equal_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, SF).toArrow()
        con.register("got", got)
        columns = ", ".join(got.column_names)
        assert Counter(con.execute(f"select {columns} from got").fetchall()) == Counter(con.execute(f"select {columns} from ({sql})").fetchall())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.train(docs, labels)
    good = {r["doc_id"] for r in quality.rate(docs, model).where("predicted = 1").collect()}
    last = {}
    for d in good:
        last[texts[d]] = max(d, last.get(texts[d], -1))
    once = set(last.values())
    apart = {d for d, (_, _, kept) in brute_near([(d, texts[d]) for d in once], 5, 80).items() if kept}
    got = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, (good, once, apart, apart)):
        got = exact_dedup.staged(stage(spark, got, SF), name)
        assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(want), name
    clean = pii.redacted(docs.where(docs["doc_id"].isin(list(apart))), pii.train(docs.where(docs["doc_id"].isin(list(apart)))))
    assert {(r["doc_id"], r["text"]) for r in clean.collect()} == {(r["doc_id"], r["text"]) for r in got.collect()}
    packed = corpus_pipeline.run(spark, SF)
    coder = packing.ChunkIds(packing.public_tokenizer())
    assert sum(r["length"] for r in packed.collect()) == sum(len(coder.whole(r["text"] or "")) // 4 + 1 for r in got.collect())
