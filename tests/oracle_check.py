"""Compare registered queries with their SQL on the same tables.

Run as a script for a table of results: ``python tests/oracle_check.py [--sf DIR] [name ...]``.
``--spread`` keeps small partitions apart and never broadcasts on its own, as large data would.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int",
    "float": "float", "double": "float", "string": "text", "varchar": "text", "date": "date",
    "boolean": "bool",
}


def family(name: str) -> str:
    name = name.lower()
    return "decimal" if name.startswith("decimal") else FAMILIES.get(name, name)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted(rows):
    return sorted((tuple(map(_plain, r)) for r in rows), key=repr)


def compare(
    spark, con, name: str, folder: str, queries, oracles, inspect=None
) -> tuple[bool, str, float]:
    """Whether the query equals its SQL, a note, and seconds; ``inspect`` sees the DataFrame."""
    start = time.time()
    df = queries[name](spark, folder)
    if inspect:
        inspect(df)
    order = sorted(df.columns)
    mine = [tuple(r) for r in df.select(*[f"`{c}`" for c in order]).collect()]
    seconds = time.time() - start
    if name not in oracles:
        return bool(mine), f"{len(mine)} rows, no SQL", seconds
    rel = con.sql(oracles[name])
    if sorted(rel.columns) != order:
        return False, f"columns {order} vs {sorted(rel.columns)}", seconds
    kinds = dict(zip(rel.columns, (family(str(t)) for t in rel.types)))
    types = {c: (family(t), kinds[c]) for c, t in df.dtypes if family(t) != kinds[c]}
    if types:
        return False, f"types {types}", seconds
    theirs = [tuple(r) for r in rel.select(*[f'"{c}"' for c in order]).fetchall()]
    a, b = _sorted(mine), _sorted(theirs)
    if a == b:
        return True, f"{len(a)} rows" + ("" if a else " (EMPTY)"), seconds
    odd = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return False, f"{len(a)} vs {len(b)} rows, first differences {str(odd)[:400]}", seconds


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        folder, args = args[1], args[2:]
    builder = SparkSession.builder
    if "--spread" in args:
        args.remove("--spread")
        builder = (
            builder.config("spark.sql.adaptive.coalescePartitions.enabled", "false")
            .config("spark.sql.autoBroadcastJoinThreshold", "-1")
            .config("spark.sql.files.maxPartitionBytes", "200k")
        )
    spark = (
        builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in args or queries:
        try:
            ok, note, seconds = compare(spark, con, name, folder, queries, oracles)
        except Exception as error:  # report and go on with the next query
            ok, note, seconds = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {seconds:6.2f}s {name}: {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
