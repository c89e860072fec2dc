"""Compare queries with their SQL in DuckDB: python tests/check.py SF_DIR [name ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(normal(row[i]) for i in order) for row in rows
    )


def compare(spark, db, sf_dir, run, sql):
    """(matches, rows, note)"""
    df = run(spark, sf_dir)
    ours = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(ours[1]) > 0, len(ours[1]), "rows only"
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = sorted_rows(columns, result.fetchall())
    if ours[0] != theirs[0]:
        return False, len(ours[1]), f"columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        note = f"{len(ours[1])} / {len(theirs[1])} rows; {[str(sorted(s)[:2])[-300:] for s in (left, right)]}"
        return False, len(ours[1]), note
    return True, len(ours[1]), "equal"


def main():
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls = connect(sf_dir), entry.oracle_sql()
    failed = []
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            ok, rows, note = compare(spark, db, sf_dir, run, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            ok, rows, note = False, 0, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:28} {rows:8} {time.time() - start:6.1f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
