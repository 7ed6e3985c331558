"""Driver contract: entry, registry/oracle consistency, a few oracle comparisons at sf0.001."""
import duckdb

import __spark_entry__ as E
from oracle.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"city_key", "station_key", "ts", "demand"} <= set(df.columns)


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_selected_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    names = ["station_hour_table", "station_hour_targets", "load_splits", "te_oof", "score_summary",
             "acf_hourly", "poi_features", "enrich_fullyear"]
    qs, sqls = E.queries(), E.oracle_sql()
    for n in names:
        sdf = qs[n](spark, SF)
        rel = con.sql(sqls[n])
        hs, _ = digest(sdf.columns, [tuple(r) for r in sdf.collect()])
        hd, _ = digest(rel.columns, rel.fetchall())
        assert hs == hd, n
