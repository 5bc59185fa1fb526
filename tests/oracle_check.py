"""Compare query results with their expected ones from DuckDB."""

from __future__ import annotations

import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def bag(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    rows = frame.where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(rows, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Problems found, empty if the result equals the expected one."""
    problems = []
    want = con.sql(sql)
    want_types = dict(zip(want.columns, map(str, want.types)))
    got_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), "?") for f in df.schema}
    if want_types != got_types:
        problems.append(f"types {set(want_types.items()) ^ set(got_types.items())}")
    got_rows, want_rows = bag(df.toPandas()), bag(want.df())
    if len(got_rows) != len(want_rows):
        problems.append(f"{len(got_rows)} rows, expected {len(want_rows)}")
    if got_rows != want_rows:
        extra = [g for g in got_rows if g not in set(want_rows)][:2]
        lacking = [w for w in want_rows if w not in set(got_rows)][:2]
        problems.append(f"surplus {extra} missing {lacking}")
    return problems


if __name__ == "__main__":
    import sys

    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1]
    names = sys.argv[2:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sql = e.oracle_sql()
    for name in names:
        start = time.time()
        try:
            df = e.queries()[name](spark, sf)
            found = differences(df, con, sql[name]) if name in sql else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(name, "ok" if not found else found, round(time.time() - start, 2), flush=True)
