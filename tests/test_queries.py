"""Every query with SQL against DuckDB over the smallest tables, where those are there."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

from textmill.plans import queries as plans  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    if name not in plans.SQL:
        assert got
        return
    rel = con.sql(plans.SQL[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want


def test_table_formats_odd_cells(spark, tmp_path):
    """Empty texts, nulls, NUL beside what CSV puts in quotes, and carriage returns come back from each form as the SQL has them."""
    bits = ["", "a", "é", " ", "\n", "\r", "\r\n", '"', ",", "\\", "\x00", "null"]
    texts = [None, *(a + b + c for a in bits for b in bits for c in bits)]
    rows = [(i, t, (None, "", "en", "\x00,")[i % 4]) for i, t in enumerate(texts)] + [(None, None, None), (None, "", "")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(c.sql(plans.SQL["table_formats"]).fetchall(), key=repr)
    assert sorted((tuple(r) for r in plans.QUERIES["table_formats"](spark, str(tmp_path)).collect()), key=repr) == want and len(want) == 4 * len(rows)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
