"""Run registered queries next to their SQL twins: ``python -m tests.oracle [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NA or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    return 0.0 if isinstance(value, float) and value == 0 else value


def _kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: frame[c].dtype.kind for c in sorted(frame.columns)}


def rows(frame: pd.DataFrame) -> Counter:
    columns = [frame[c].tolist() for c in sorted(frame.columns)]
    return Counter(tuple(_cell(v) for v in row) for row in zip(*columns))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when both hold the same rows, otherwise what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = [f"{c}: {k} != {w}" for (c, k), w in zip(_kinds(got).items(), _kinds(want).values()) if k != w]
    a, b = rows(got), rows(want)
    if a == b:
        return "types " + ", ".join(kinds) if kinds else ""
    extra, lost = list((a - b).items())[:2], list((b - a).items())[:2]
    text = f"rows {len(got)} / {len(want)}; only here {extra}; only SQL {lost}; types {kinds}"
    return text if len(text) < 1500 else text[:1500]


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tokenloom.plans.session import local_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql, con = entry.queries(), entry.oracle_sql(), duck(sf)
    bad = 0
    for name in argv[1:] or queries:
        begin = time.time()
        try:
            got = queries[name](spark, sf).toPandas()
            spent = time.time() - begin
            begin = time.time()
            result = compare(got, con.execute(sql[name]).df()) if name in sql else "no SQL twin"
            state = {"": "same", "no SQL twin": "rows"}.get(result, "DIFF")
            result = f"{len(got)} rows" if not result else result
        except Exception as error:  # noqa: BLE001
            spent, state, result = time.time() - begin, "FAIL", str(error)[:900]
        bad += state in ("DIFF", "FAIL")
        print(f"{state:5} {name:30} {spent:6.2f}s sql {time.time() - begin:5.2f}s {result}", flush=True)
    print(f"{bad} of {len(argv[1:] or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
