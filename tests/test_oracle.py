"""Spark result == DuckDB oracle on sf0.001 for a representative set of queries
(the driver runs the full set at sf0.01; tools/oracle_check.py does it locally)."""

import math

import pytest

SF = "/root/testdata/sf0.001"
NAMES = ["val_clean", "val_reject_reasons", "prf_hourly", "prf_describe", "prf_boxplot_by_passengers",
         "prf_calendar_means", "geo_airport_range_join", "ft_features", "met_errors", "met_cost", "lkg_leakage",
         "drf_psi", "prc_score_trip", "gat_decision", "mon_alerts", "pp_clip_fit", "pp_ordinal_apply",
         "sel_mutual_information", "spl_time_split", "mod_select_best", "cab_bucket_width", "src_sample_n"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e

    df = e.queries()[name](spark, SF)
    res = duck.execute(e.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())
