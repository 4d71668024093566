"""Run registered queries and their SQL side by side: python tests/check_catalog.py SF [NAME ...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = "documents pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs between two results, rows in any order; None if nothing does."""
    columns = sorted(want.columns)
    if sorted(got.columns) != columns:
        return f"columns {sorted(got.columns)} != {columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = (
        df[columns].sort_values(columns, ignore_index=True) for df in (got, want)
    )
    for column in columns:
        if want[column].dtype == "Int64":  # integers with nulls
            got[column] = got[column].astype("Int64")
        if got[column].dtype.kind != want[column].dtype.kind:
            return f"{column}: type {got[column].dtype} != {want[column].dtype}"
        wrong = (got[column] != want[column]).fillna(True) & ~(got[column].isna() & want[column].isna())
        if wrong.any():
            i = wrong.idxmax()
            return f"{column}: {int(wrong.sum())} rows, e.g. {got[column][i]!r} != {want[column][i]!r}"
    return None


def main() -> None:
    from tests.session import spark_session

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark = spark_session()
    connection = connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        begin = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            spent = time.time() - begin
            want = connection.execute(oracle[name]).df() if name in oracle else None
            result = difference(got, want) if want is not None else "(no SQL)"
        except Exception as error:  # report and go on with the next query
            spent, got, result = time.time() - begin, (), f"{type(error).__name__}: {str(error)[:600]}"
        bad += result not in (None, "(no SQL)")
        print(f"{name:28s} {spent:6.2f}s {len(got):7d} rows  {(result or 'ok')[:900]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
