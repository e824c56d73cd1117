"""The driver's contract: names, columns and SQL of the queries of the engine."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from weftline.plans import registry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, sql, name):
    df = registry.QUERIES[name](spark, SMALL)
    cursor = sql.execute(registry.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert got == sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_other_queries_return_rows(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_artifacts_give_the_nodes_back(spark):
    from weftline.sources.bridge import page_nodes

    want = {(r["page_id"], r["node_idx"], r["text"], r["x"], r["h"]) for r in page_nodes(spark, SMALL).collect()}
    got = {(r["artifact_id"], r["node_idx"], r["text"], r["x"], r["h"]) for r in registry.QUERIES["jsonld_nodes"](spark, SMALL).collect()}
    assert got == want


def test_artifacts_are_read_once(spark):
    """Nodes and the rectangles they refer to come from one scan, without a join of the documents with themselves."""
    from weftline.sources import readers

    docs = spark.range(3).selectExpr("id AS artifact_id", "'{\"@graph\":[]}' AS doc")
    plan = readers.artifact_nodes(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Range (") == 1


def test_stream_equals_batch(spark):
    batch = {(str(r["template"]), r["seq"]): r["running_mean"] for r in registry.QUERIES["drift_history"](spark, SMALL).collect()}
    stream = {(r["template"], r["seq"]): r["running_mean"] for r in registry.QUERIES["drift_stream"](spark, SMALL).collect()}
    assert stream == pytest.approx(batch, abs=1e-8)
