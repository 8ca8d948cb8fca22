"""Every query of the catalogue against its SQL in DuckDB on the driver's smallest tables."""

import glob
import os

import duckdb
import pytest

from gridloom.plans import catalog, stages  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def _plain(v):
    if v is None or isinstance(v, float) and v != v:
        return "None"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(round(float(v), 6))
    return str(list(v)) if isinstance(v, (list, tuple)) else str(v)


def same_rows(df, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(tuple(_plain(dict(zip(names, r))[c]) for c in order) for r in got.fetchall())
    have = sorted(tuple(_plain(r[c]) for c in order) for r in df.collect())
    assert have == want


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, name):
    same_rows(catalog.QUERIES[name](spark, SMALL), catalog.ORACLES[name])


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
def test_clean_text_reads_every_line(spark):
    out = catalog.QUERIES["clean_text"](spark, SMALL).filter("kind = 'document'")
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()
    assert out.count() == sum(r.text.count("\n") + 1 for r in texts if r.text is not None)
