import math

import duckdb

import __spark_entry__ as E
from chanfold.plans.layers import DRIVER_TABLES
from conftest import SF_SMALL

FAST_KEYS = ["kpi_country_month", "kpi_all_cuts", "member_uplift", "fx_missing_rates",
             "conform_franchise", "code_inference", "validate_fact", "profile_distinct"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["country", "year_month"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def test_oracle_agreement_small(spark):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for key in FAST_KEYS:
        df = E.queries()[key](spark, SF_SMALL)
        cur = con.execute(E.oracle_sql()[key])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns), key
        s = sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
        idx = [names.index(c) for c in sorted(df.columns)]
        d = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
        assert s == d, key
