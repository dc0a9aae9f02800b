"""Run queries against their SQL: python -m tests.check_queries [folder] [name ...]"""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from tests.compare import connect, differences
from textloom.session import spark_session


def main(folder: str, names: list[str]) -> int:
    spark = spark_session(
        "check",
        "local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            result = differences(df, connection, sql[name]) if name in sql else f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(result)
        print(f"{name:24} {time.time() - start:6.1f}s  {result or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
