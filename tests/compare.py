"""Run registered queries against DuckDB: ``python tests/compare.py FOLDER [QUERY...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

KINDS = {
    "bigint": "int64", "int": "int32", "double": "double", "string": "varchar",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in df.itertuples(index=False)]
    return sorted(rows, key=repr)


def difference(spark_df, expected: pd.DataFrame) -> str | None:
    """Why two results differ, or None."""
    got = spark_df.toPandas()
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} and {sorted(expected.columns)}"
    kinds = [
        (c, str(got[c].dtype), str(expected[c].dtype))
        for c in got.columns
        if len(got) and str(got[c].dtype) != str(expected[c].dtype)
    ]
    if kinds:
        return f"types {kinds}"
    if len(got) != len(expected):
        return f"{len(got)} rows and {len(expected)} rows"
    left, right = _sorted(got), _sorted(expected)
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(pairs)} rows differ, first {pairs[0]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from grainfold.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    sql, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            expected = con.execute(sql[name]).df()
            mid = time.time()
            why = difference(query(spark, folder), expected)
        except Exception as error:  # report and go on with the next query
            mid, why, expected = time.time(), f"{type(error).__name__}: {str(error)[:1500]}", []
        bad += why is not None
        print(f"{'ok ' if why is None else 'BAD'} {name} rows={len(expected)} "
              f"spark={time.time() - mid:.2f}s sql={mid - started:.2f}s {why or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
