"""Runs registered queries in Spark and their SQL in DuckDB and compares the results exactly.

``python -m tests.sql_check [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as contract
from tallymill.session import build_session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*names).collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def kinds(df, con, sql: str) -> dict[str, tuple[str, str]]:
    """Columns whose types differ: name -> (Spark, SQL)."""
    there = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    here = {name: _KINDS.get(kind, kind) for name, kind in df.dtypes}
    return {c: (here[c], there.get(c)) for c in here if here[c] != there.get(c)}


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs, or None."""
    df = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql()[name]
    names, ours = spark_rows(df)
    their_names, theirs = sql_rows(con, sql)
    if names != their_names:
        return f"columns {names} / {their_names}"
    wrong_kinds = kinds(df, con, sql)
    if wrong_kinds:
        return f"types {wrong_kinds}"
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        return (
            f"rows {ours.total()} / {theirs.total()}; only Spark {only_ours.total()} "
            f"{list(only_ours)[:3]}; only SQL {only_theirs.total()} {list(only_theirs)[:3]}"
        )
    return None if ours.total() else "no rows"


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(master="local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for query in sys.argv[2:] or contract.queries():
        begun = time.time()
        try:
            said = compare(session, connection, folder, query)
        except Exception as error:  # report and go on with the next query
            said = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - begun:6.2f}s {'ok  ' if said is None else 'DIFF'} {query} {said or ''}", flush=True)
