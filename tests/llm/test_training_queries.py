"""Queries beside their SQL twins, and every query's shape."""

import duckdb
import pytest

from letbook.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


#: Queries over another table than the documents: a row per key at least.
OVER = {"op11_repair": ("conversations", "conv_id"), "op12_html": ("pages", "page_id")}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(tuple(r) for r in ours.select(*columns).collect()) == sorted(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    table, key = OVER.get(name, ("documents", "doc_id"))
    assert rows.count() >= spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).distinct().count()
