"""Compare registered queries with their SQL on DuckDB.  Run as a script: oracle.py SF_DIR [names...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, float):
        return ("float", repr(v))
    if isinstance(v, int):
        return ("int", v)
    return (type(v).__name__, str(v))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """``None`` if both sides hold the same rows and column names, else what differs."""
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    want = _rows(names, expected.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)} sql {sorted(names)}"
    if want != got:
        extra, missing = got - want, want - got
        return (
            f"rows: spark {sum(got.values())} sql {sum(want.values())}; only spark {sum(extra.values())} "
            f"{str(list(extra)[:3])[:600]}; only sql {sum(missing.values())} {str(list(missing)[:3])[:600]}"
        )
    return None


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from modlens.session import build_session

    import __spark_entry__ as entry

    sf_dir, names = argv[0], [a for a in argv[1:] if a != "-q"]
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF" if "-q" in argv else "ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = differences(queries[name](spark, sf_dir), con, oracles[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() > 0 else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{kind}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names or queries)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
