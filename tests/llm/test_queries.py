"""Queries with SQL against DuckDB on the smallest tables; all others run and keep every row."""

from __future__ import annotations

import duckdb
import pytest

from stratavox.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    other = duck.sql(ORACLE_SQL[name])
    assert sorted(other.columns) == columns
    at = [other.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in other.fetchall())


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op3_fingerprints", "op4_suffix_dedup", "op6_simhash", "op10_toxicity"])
def test_a_row_for_each_document(spark, duck, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, DATA).select("doc_id").collect()]
    assert sorted(ids) == sorted(r[0] for r in duck.sql("SELECT doc_id FROM documents").fetchall())


def test_toxicity_on_held_out_rows(spark):
    data = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op10_toxicity"](spark, data).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] == 1 for r in rows)
    assert right >= 0.9 * sum(r["toxic"] for r in rows) and right >= 0.95 * sum(r["predicted"] for r in rows)
