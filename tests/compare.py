"""Compare registered queries with their SQL: python tests/compare.py FOLDER [NAME ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
from quipyard.session import build_session


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return repr(float(f"{value:.12g}"))
    if isinstance(value, datetime):
        return value.isoformat()
    return repr(value)


_SAME_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}


def differences(found, connection, name: str) -> list[str]:
    """What is not the same between a query's result and its SQL; empty if all is."""
    rows = found.collect()
    relation = connection.sql(contract.oracle_sql()[name])
    expected = relation.fetchall()
    columns = sorted(found.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} against {sorted(relation.columns)}"]
    problems = []
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    for column, kind in found.dtypes:
        if _SAME_TYPES.get(sql_types[column], sql_types[column]) != kind:
            problems.append(f"type of {column}: {kind} against {sql_types[column]}")
    ours = Counter(tuple(_cell(row[c]) for c in columns) for row in rows)
    order = [relation.columns.index(c) for c in columns]
    theirs = Counter(tuple(_cell(row[i]) for i in order) for row in expected)
    if ours != theirs:
        extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
        problems.append(f"{len(rows)} rows against {len(expected)}; {len(extra)} extra, {len(missing)} missing")
        for label, sample in (("extra", extra), ("missing", missing)):
            problems += [f"{label}: {str(row)[:600]}" for row in sorted(sample)[:1]]
    elif not rows:
        problems.append("no rows")
    return problems


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(contract.queries())
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(folder)
    failed = 0
    for name in names:
        start = time.time()
        if name not in contract.oracle_sql():
            print(f"{name}: no SQL, {contract.queries()[name](spark, folder).count()} rows")
            continue
        try:
            problems = differences(contract.queries()[name](spark, folder), connection, name)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{name}: {'ok' if not problems else 'DIFFERENT'} {time.time() - start:.1f}s", *problems, sep="\n    ")
    print(f"{len(names)} queries, {failed} with differences")


if __name__ == "__main__":
    main()
