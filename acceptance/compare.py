"""Compare a query's rows with those of its SQL twin."""

import datetime
import decimal
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return _sorted(names, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value
