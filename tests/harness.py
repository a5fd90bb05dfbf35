"""Run a registered query on Spark and its SQL on DuckDB and compare schema and rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = os.environ.get("TRAMLINE_TESTDATA", "/root/testdata")

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def norm(row):
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else (0.0 if v == 0 and isinstance(v, float) else v) for v in row)


def differences(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    relation = con.sql(sql)
    duck = dict(zip(relation.columns, map(str, relation.types), strict=True))
    spark = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if duck != spark:
        return f"schema: spark {sorted(spark.items() - duck.items())} duckdb {sorted(duck.items() - spark.items())}"
    names = sorted(duck)
    order = [relation.columns.index(n) for n in names]
    expected = sorted((norm(r[i] for i in order) for r in relation.fetchall()), key=repr)
    actual = sorted((norm(r[n] for n in names) for r in df.collect()), key=repr)
    if len(expected) != len(actual):
        return f"rows: spark {len(actual)} duckdb {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, columns {names}: spark {wrong[0][0]} duckdb {wrong[0][1]}"
    return None
