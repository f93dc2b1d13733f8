import __spark_entry__ as entry
from conftest import SF_SMALL


def test_every_oracle_has_a_query_and_names_are_unique():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) > 100


def test_flagship_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["market", "mae", "rmse", "mape", "r2", "n_rows", "n_null"]
    assert sorted(r["market"] for r in rows) == ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    assert all(r["n_rows"] > 0 for r in rows)


def test_oracle_checked_queries_run_on_smallest_data(spark):
    import duckdb
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duckdb.connect()
    for t in ["events", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ["w1_target_lags", "i1_ffill_bfill", "l4_ridge_two_features", "a4_describe"]:
        s = qs[name](spark, SF_SMALL).count()
        d = con.execute(f"SELECT count(*) FROM ({sql[name]})").fetchone()[0]
        assert s == d, name
