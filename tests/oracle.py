"""Run registered queries in Spark and their checking SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, v) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(spark, con, key, query, sql, sf_dir) -> tuple[str | None, int, float]:
    """(None or a description of the first difference, row count, seconds in Spark)."""
    started = time.time()
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*names).collect()]
    seconds = time.time() - started
    if sql is None:
        return None, len(ours), seconds
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    expected = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    if described != expected:
        return f"schema: {described} against {expected}", len(ours), seconds
    theirs = [tuple(r) for r in con.execute(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()]
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} against {len(theirs)}", len(ours), seconds
    ours.sort(key=_key)
    theirs.sort(key=_key)
    wrong = [(a, b) for a, b in zip(ours, theirs) if not all(_same(x, y) for x, y in zip(a, b))]
    if wrong:
        a, b = wrong[0]
        diff = [(n, x, y) for n, x, y in zip(names, a, b) if not _same(x, y)]
        return f"{len(wrong)} rows differ, first: {diff} in {a}", len(ours), seconds
    return None, len(ours), seconds


def main(argv):
    from tidemark.session import build_session
    import __spark_entry__ as entry

    sf = argv[0] if argv else "sf0.01"
    wanted = argv[1:]
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session("oracle", "local[8]", 8, **{"spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for key, query in queries.items():
        if wanted and not any(w == key or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        try:
            problem, rows, seconds = compare(spark, con, key, query, oracles.get(key), sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:1500]}", -1, 0.0
        failed += problem is not None
        checked = "checked" if key in oracles else "rows only"
        print(f"{'FAIL' if problem else 'ok  '} {key:32s} {rows:7d} rows {seconds:6.2f}s {checked} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
