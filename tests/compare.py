"""Run registered queries in Spark and their SQL in DuckDB and compare the results exactly."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def kind(value) -> object:
    """A value in a form both engines share. Floats stay exact."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return ("n", float(value))
    if isinstance(value, float):
        return ("n", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("d", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(kind(v) for v in value)
    return str(value)


FAMILY = {
    "int": "int", "bigint": "int", "double": "double", "string": "text", "boolean": "bool", "date": "date",
    "timestamp": "time", "timestamp_ntz": "time", "INTEGER": "int", "BIGINT": "int", "DOUBLE": "double",
    "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "time", "HUGEINT": "huge",
}


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(kind(r[i]) for i in order) for r in rows)


def compare(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between the two results; empty when they are the same."""
    found = con.sql(sql)
    problems = []
    if sorted(spark_df.columns) != sorted(found.columns):
        return [f"columns: {sorted(spark_df.columns)} against {sorted(found.columns)}"]
    left = {n: FAMILY.get(t, t) for n, t in spark_df.dtypes}
    right = {n: FAMILY.get(str(t), str(t)) for n, t in zip(found.columns, found.types)}
    for n in left:
        if left[n] != right[n] and right[n] != '"NULL"':
            problems.append(f"type of {n}: {left[n]} against {right[n]}")
    a = rows_of(spark_df.columns, spark_df.collect())
    b = rows_of(found.columns, found.fetchall())
    if a != b:
        only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
        problems.append(
            f"rows: {sum(a.values())} against {sum(b.values())}, "
            f"{sum((a - b).values())} differ\n  spark {only_a}\n  sql   {only_b}"
        )
    elif not a:
        problems.append("empty result")
    return problems


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("closeworks")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="closeworks-test-"))
        .getOrCreate()
    )


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(queries()[name](spark, sf_dir), con, sql[name]) if name in sql else ["no SQL"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n  " if problems else "")
    print(f"{len(names) - bad} of {len(names)} equal; without a query: {sorted(set(sql) - set(queries()))}")


if __name__ == "__main__":
    main()
