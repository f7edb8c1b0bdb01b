"""Helper for tests: compare one registered query with its DuckDB oracle."""

import duckdb

import __spark_entry__ as E
from tools.check_oracle import TABLES, _rows


def compare(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    import pandas as pd

    sdf = E.queries()[name](spark, sf)
    spd = pd.DataFrame([r.asDict(recursive=True) for r in sdf.collect()], columns=sdf.columns)
    dpd = con.execute(E.oracle_sql()[name]).fetchdf()
    return _rows(spd) == _rows(dpd)
