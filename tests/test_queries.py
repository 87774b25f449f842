"""Every registered query of the tables against its SQL, on the smallest given tables."""

import duckdb
import pytest

from keyweave.plans import queries
from keyweave.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(([str(r[i]) for i in order] for r in data))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    got = QUERIES[name](spark, FOLDER)
    want = database.execute(SQL[name])
    assert rows(got.columns, got.collect()) == rows([c[0] for c in want.description], want.fetchall())


def test_all_have_sql_and_the_entry_runs(spark):
    import __spark_entry__ as entry

    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).columns == ["PK", "SK", "ADDITIONAL_PK", "attr1", "create_time", "expTm", "sqltypeattr"]


def test_shapes_of_plans(spark):
    plan = lambda name: QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan("build_keyfile") and "Generate" not in plan("check_fanout")
    assert not any("Python" in plan(n) or "Arrow" in plan(n) for n in QUERIES if not n.startswith("json"))


def test_wide_items_has_all_days_of_every_key(spark):
    made = QUERIES["wide_items"](spark, FOLDER)
    keys = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey").distinct().count()
    assert [tuple(r) for r in made.groupBy("n_items").count().collect()] == [(92, keys)]


def test_documents_are_dealt_out_by_lines(spark, monkeypatch):
    monkeypatch.setattr(queries, "LINES_PER_TASK", 500)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert queries.documents(spark, FOLDER).rdd.getNumPartitions() == -(-lines // 500) > spark.sparkContext.defaultParallelism


def test_only_objects_are_joined_with_what_they_hold(spark):
    plan = QUERIES["json_node_parents"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "= object" in plan
