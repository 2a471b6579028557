"""Runs queries beside their SQL and compares rows as multisets."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

_FAMILY = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean",
}


def connect(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark: SparkSession, connection, query, sql: str, root: str) -> str | None:
    """What differs between a query's rows and those of its SQL, or None."""
    result = query(spark, root)
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema}
    cursor = connection.execute(sql)
    duck_types = {d[0]: _FAMILY.get(str(d[1]), str(d[1])) for d in cursor.description}
    duck_rows = cursor.fetchall()
    if spark_types != duck_types:
        odd = {k: (spark_types.get(k), duck_types.get(k)) for k in {*spark_types, *duck_types}}
        return f"columns: { {k: v for k, v in odd.items() if v[0] != v[1]} }"
    names = sorted(spark_types)
    order = [list(duck_types).index(n) for n in names]
    ours = Counter(tuple(row[n] for n in names) for row in result.collect())
    theirs = Counter(tuple(row[i] for i in order) for row in duck_rows)
    if ours == theirs:
        return None
    return (
        f"rows {sum(ours.values())} against {sum(theirs.values())}; columns {names}; "
        f"only in Spark {list((ours - theirs).items())[:3]}; only in SQL {list((theirs - ours).items())[:3]}"
    )
