import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """The small documents and the awkward rows: nulls, empty and repeated ones, long texts, ties."""
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    long_text = " ".join(f"word{i % 977} and {i}" for i in range(20_000))
    odd = [
        (1_000_001, None, None, None, None), (1_000_002, "", "en", "s", 0), (1_000_003, " \n\t ", "en", "s", 4), (1_000_004, "one", "en", "s", 3), (1_000_005, "one two", "en", "s", 7),
        (1_000_006, "One  TWO", "en", "s", 8), (1_000_007, long_text, "en", "s", len(long_text)), (1_000_008, long_text + " end", "en", "s", len(long_text) + 4), (1_000_009, "a" * 50_000, "en", "s", 50_000),
        (1_000_010, "ab" * 500, "en", "s", 1000), (1_000_011, "mail a.b@c.de_x@y.zz and 999.1.1.1 1.2.3.4.5 4111 1111 1111 1111 +1 (222) 333-4444 \U0001F600 x@y.z", "en", "s", 90),
        (1_000_012, "mail a.b@c.de_x@y.zz and 999.1.1.1 1.2.3.4.5 4111 1111 1111 1111 +1 (222) 333-4444 \U0001F600 x@y.z", "en", "s", 90), (1_000_013, "# $ ***\nsame line here\nsame line here\n\n", "en", "s", 40),
        (1_000_013, "# $ ***\nsame line here\nsame line here\n\n", "en", "s", 40),
    ]
    return whole.unionByName(spark.createDataFrame(odd, SCHEMA)).withColumn("digest", F.lit("clash")).withColumn("id", F.lit("clash")).withColumn("kept", F.lit("clash"))


@pytest.fixture(scope="session")
def texts(docs):
    """(doc_id, text) pairs, rows as they are."""
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
