"""Compare a query with its SQL, value by value."""

from __future__ import annotations

import datetime as dt
import sys

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    try:
        import duckdb
    except ImportError:
        sys.path.insert(0, "/opt/oracle")
        import duckdb
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(
        (tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr
    )


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    rows = result.fetchall()
    return columns, sorted(
        (tuple(_plain(r[names.index(c)]) for c in columns) for r in rows), key=repr
    )


def difference(spark, sf_dir, run, sql):
    """None if both give the same rows, else a short report."""
    columns, got = spark_rows(run(spark, sf_dir))
    wanted_columns, wanted = duck_rows(duck(sf_dir), sql)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if got != wanted:
        only_got = [r for r in got if r not in set(wanted)][:3]
        only_wanted = [r for r in wanted if r not in set(got)][:3]
        return f"{len(got)} rows != {len(wanted)}; only Spark {only_got}; only SQL {only_wanted}"
    if not got:
        return "no rows"
    return None
