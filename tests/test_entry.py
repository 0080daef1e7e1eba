import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"value_median", "value_std", "location_id"} <= set(df.columns)


def test_every_query_has_an_oracle():
    from hazelake.plans import catalog
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _duck():
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_flagship_queries_match_oracle_small(spark):
    con = _duck()
    for name in ("hourly_fact", "outliers_iqr", "quality_report", "alert_once_per_slot", "upsert_dim_location",
                 "recipient_batches"):
        df = E.queries()[name](spark, SF_SMALL)
        got = sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in
                     df.select(*sorted(df.columns)).collect())
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(tuple(str(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in order)
                      for r in res.fetchall())
        assert len(got) == len(want), name
        assert got == want, name
