import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names_and_sql_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["win_top_per_doc", "flt_regex_hit", "fn_token_chunks", "agg_doc_prompt", "join_neighbors", "snk_upsert", "set_allowed_norm", "gr_transitive_admin"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    got = entry.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    plain = lambda rows: sorted(repr(tuple(str(v) for v in r)) for r in rows)
    assert plain(got.select(*columns).collect()) == plain(want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
