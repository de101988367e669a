"""Every query beside the SQL that says what it must return."""

from __future__ import annotations

import duckdb
import pytest

from rosterlake.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple("NULL" if v is None or v != v else str(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert rows(found) == rows(duck.sql(ORACLES[name]).df())
    else:
        assert len(found)


def test_titles_cut_off_in_a_reference(spark, tmp_path):
    titles = ["a = &quot", "a = &quot;b", " &amp;&amp &am", "&lt;&#39; &copy", "\u3000 a\t", "&amp;quot;", "&amp;amp;", ""]
    pages = [(i, f"<head><title>{t}</title><script>'</p>'</script></head><a href=/x?a=1&amp;b>x</a><p><a href='/y'>y") for i, t in enumerate(titles)]
    frame = spark.createDataFrame([*pages, (98, "<p>no title"), (99, None)], "page_id long, html string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    found = QUERIES["page_titles_links"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(c.sql(ORACLES["page_titles_links"]).fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
