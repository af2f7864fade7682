from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from studyflow.plans import load_all

QUERIES, ORACLES = load_all()
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, db, name):
    got = entry.queries()[name](spark, SF).toArrow()
    db.register("got", got)
    columns = ", ".join(f'"{c}"' for c in sorted(got.column_names))
    sql = entry.oracle_sql()[name]
    assert Counter(db.execute(f"select {columns} from got").fetchall()) == Counter(db.execute(f"select {columns} from ({sql})").fetchall())
