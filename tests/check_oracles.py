"""Run every registered query beside its SQL: ``python tests/check_oracles.py FOLDER [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def plain(value):
    """A value that tells -0.0 from 0.0, NaN from NULL and 1 from 1.0."""
    return (type(value).__name__, repr(value))


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder, name, run, sql):
    """None when equal, else what differs."""
    df = run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} vs {names}"
    a, b = comparable(df.columns, got), comparable(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, run, oracles.get(name))
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:20s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
