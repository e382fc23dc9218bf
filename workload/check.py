"""Compare each query with its SQL check on one folder."""

import glob
import math
import os
import sys
import time

import duckdb

from murmur.session import get_spark
from workload.oracle import ORACLE
from workload.queries import QUERIES


def connect(folder: str):
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def same_value(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def compare(name: str, spark, db, folder: str) -> str:
    start = time.time()
    df = QUERIES[name](spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    start = time.time()
    relation = db.execute(ORACLE[name])
    columns, want = rows_of([d[0] for d in relation.description], relation.fetchall())
    sql = time.time() - start
    timing = f"{len(got)} rows, spark {took:.1f}s, sql {sql:.1f}s"
    if got_columns != columns:
        return f"FAILED columns {got_columns} != {columns}"
    if len(got) != len(want):
        extra = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
        return f"FAILED {len(got)} rows, SQL has {len(want)}; {str(extra)[:900]}"
    for a, b in zip(got, want):
        if not all(same_value(x, y) for x, y in zip(a, b)):
            return f"FAILED {timing}\n    spark {str(a)[:500]}\n    sql   {str(b)[:500]}"
    return f"ok {timing}" + ("" if got else "  EMPTY")


def main(folder: str, names: list[str]) -> int:
    spark = get_spark("murmur-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.murmur.readPartitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in names or ORACLE:
        try:
            result = compare(name, spark, db, folder)
        except Exception as e:
            result = f"FAILED {type(e).__name__}: {str(e)[:700]}"
        failed += result.startswith("FAILED")
        print(f"{name:24s} {result}", flush=True)
    print("without SQL:", sorted(set(QUERIES) - set(ORACLE)), "failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
