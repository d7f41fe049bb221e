"""Run every query next to its SQL and compare all values.

    python -m samplemap.compare [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from remitlens.session import build_session
from samplemap.answers import ANSWERS
from samplemap.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    return str(v) if isinstance(v, Decimal) else v


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_value(v) for v in row) for row in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter, list[str]]:
    cursor = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(cursor.description)), key=lambda i: cursor.description[i][0])
    names = [cursor.description[i][0] for i in order]
    rows = Counter(tuple(_value(row[i]) for i in order) for row in cursor.fetchall())
    return names, rows, [kinds[n] for n in names]


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}


def compare(spark, con, key: str, sf_dir: str) -> str:
    start = time.time()
    df = QUERIES[key](spark, sf_dir)
    names, got = spark_rows(df)
    spent = time.time() - start
    want_names, want, kinds = duck_rows(con, ANSWERS[key])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    notes = [
        f"{n}:{types[n]}/{k}" for n, k in zip(names, kinds)
        if KINDS.get(types[n], types[n].upper().replace(",", ", ")) != k.replace(",", ", ").replace(",  ", ", ")
    ]
    if names != want_names:
        verdict = f"COLUMNS {names} / {want_names}"
    elif got != want:
        only_spark, only_sql = list((got - want).items())[:2], list((want - got).items())[:2]
        verdict = f"ROWS {sum(got.values())} / {sum(want.values())}\n   spark {only_spark}\n   sql   {only_sql}"
    else:
        verdict = f"ok {sum(got.values())} rows"
    return f"{key:28s} {spent:6.1f}s {verdict} {'TYPES ' + str(notes) if notes else ''}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for key in keys:
        try:
            line = compare(spark, con, key, sf_dir)
        except Exception as error:  # report and go on with the other keys
            line = f"{key:28s} ERROR {str(error)[:1500]}"
        bad += " ok " not in line
        print(line, flush=True)
    print(f"{len(keys) - bad} of {len(keys)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
