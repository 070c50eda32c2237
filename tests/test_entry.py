"""Driver contract and DuckDB oracle agreement at sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["employer_name", "total_filings", "certified", "cert_rate_pct"]
    assert len(rows) == 50
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["q06_top_filers", "q10_growing_sponsors", "h7_grouped_view",
                                  "e9_mark_join_gc_sponsor", "j1_open_roles", "b1_staged_lca",
                                  "d2_employers", "x19_link_discovery"])
def test_oracle_agreement_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
