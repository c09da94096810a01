"""Compare a query's rows with its SQL: columns by name, rows as a multiset."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    if sorted(spark_df.columns) != sorted(relation.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(relation.columns)}"]
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = rows_of(relation.columns, relation.fetchall())
    if ours == theirs:
        return []
    return [
        f"{ours.total()} rows against {theirs.total()}",
        f"only here: {list((ours - theirs).items())[:3]}",
        f"only there: {list((theirs - ours).items())[:3]}",
    ]
