"""The driver contract, and a few queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["learned_before", "lesson_order", "transitive_reduction", "check_verdict", "bm25f_search", "krippendorff_alpha", "backoff_grouping", "delta_rebuilt"])
def test_query_equals_sql(spark, name):
    import __spark_entry__ as e

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(e.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = e.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
