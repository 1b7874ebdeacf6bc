"""Driver contract: entry runs on sf0.001, every query has oracle SQL, and
column names are unique and explicit."""

import __spark_entry__ as e
from noema.plans import catalog


def test_entry_smoke(spark):
    df = e.entry(spark)
    assert df.columns == ["seed_paper_id", "ref_paper_id", "title", "is_influential", "citation_count", "rank"]
    assert df.count() > 0


def test_every_query_has_oracle_and_clean_columns(spark):
    qs, sql = e.queries(), e.oracle_sql()
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(qs) and set(sql) <= set(qs)
    for name in ("paper_union", "wiki_links", "quality_scan", "run_stats"):
        cols = qs[name](spark, "/root/testdata/sf0.001").columns
        assert len(cols) == len(set(cols)) and all("(" not in c for c in cols), name
