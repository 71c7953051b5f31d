"""Compare every registered query with its oracle: ``python -m gleaner.catalog.check [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb
import pandas as pd

from gleaner.catalog.registry import ORACLES, QUERIES
from gleaner.catalog.views import TABLES
from gleaner.session import local_session


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (pd.Timestamp, datetime.datetime)):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "tolist"):
        value = value.tolist()
        return str([_cell(v) for v in value]) if isinstance(value, list) else _cell(value)
    if isinstance(value, list):
        return str([_cell(v) for v in value])
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str:
    """'' when query and oracle give the same rows, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return "" if mine else "no rows"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if mine == theirs:
        return "" if mine else "both empty"
    extra, missing = list(set(mine) - set(theirs))[:2], list(set(theirs) - set(mine))[:2]
    return f"{len(mine)} / {len(theirs)} rows; only here {str(extra)[:600]}; only oracle {str(missing)[:600]}"


def main(argv: list[str]) -> int:
    from gleaner import catalog  # noqa: F401
    import gleaner.catalog.all  # noqa: F401
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session("check"), oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            fault = compare(spark, con, sf_dir, name)
        except Exception as error:  # a failing query must not hide the others
            fault = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in argv:
                traceback.print_exc()
        bad += bool(fault)
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'FAIL' if fault else 'ok'} {name} [{kind}] {time.time() - start:.1f}s {fault}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
