"""Row-for-row comparison of a Spark result with the oracle's."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_rows(sql: str, folder: str) -> tuple[list[str], list[tuple], list[str]]:
    with duckdb.connect() as con:
        for name in TABLES:
            if Path(f"{folder}/{name}.parquet").exists():
                con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        types = [str(d[1]) for d in result.description]
        return names, result.fetchall(), types


def _plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return int(value) if isinstance(value, int) else value


def aligned(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple(str(x) for x in r))


def differences(spark_names, spark_rows, oracle_names, oracle_rows_) -> str | None:
    a, left = aligned(spark_names, spark_rows)
    b, right = aligned(oracle_names, oracle_rows_)
    if a != b:
        return f"columns {a} != {b}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for x, y in zip(left, right):
        if x != y:
            return f"{a}\n spark  {x}\n oracle {y}"
    return None
