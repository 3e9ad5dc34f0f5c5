"""The driver contract: entry schema, one oracle per warehouse query, and every
one of them reading the given tables."""

import __spark_entry__ as E
from martflow.plans.catalog import QUERIES


def test_queries_and_oracles_align():
    q, o = E.queries(), E.oracle_sql()
    assert len(QUERIES) >= 47 and set(QUERIES) <= set(q)
    assert set(QUERIES) <= set(o) <= set(q)
    assert all(isinstance(v, str) and v.strip() for v in o.values())


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum"]
    assert df.count() > 0


def test_every_query_reads_parquet_tables(spark):
    for name in QUERIES:
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan.lower(), name
