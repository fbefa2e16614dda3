"""Compare every registered query with its SQL on DuckDB. Usage: verify.py [folder] [name part ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd

from stratalake.plans import registry
from stratalake.session import build_session


def normalised(df: pd.DataFrame) -> list[tuple]:
    out = []
    for row in df[sorted(df.columns)].itertuples(index=False, name=None):
        out.append(tuple(_plain(v) for v in row))
    return sorted(out, key=repr)


def _plain(v):
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0) == 1:
        return tuple(_plain(x) for x in v)
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v.is_integer():
        return int(v)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s if "T" in s else s + "T00:00:00"
    return v


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


# Pairing of all rows and row-wise Python have no place in any query.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def check(spark, con, folder: str, name: str) -> tuple[str, str, float]:
    t0 = time.time()
    try:
        df = registry.QUERIES[name](registry.Tables(spark, folder))
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = [x for x in UNWANTED if x in plan]
        if found:
            return "PLAN", str(found), time.time() - t0
        got = df.toPandas()
    except Exception as e:  # noqa: BLE001
        return "ERROR", f"{type(e).__name__}: {str(e)[:600]}\n{traceback.format_exc()[-700:]}", time.time() - t0
    took = time.time() - t0
    sql = registry.SQL.get(name)
    if sql is None:
        return "rows", f"{len(got)} rows", took
    try:
        want = con.execute(sql).df()
    except Exception as e:  # noqa: BLE001
        return "SQLERR", str(e)[:800], took
    if sorted(got.columns) != sorted(want.columns):
        return "COLS", f"{sorted(got.columns)} vs {sorted(want.columns)}", took
    a, b = normalised(got), normalised(want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3] if len(a) < 20000 else []
        only_b = [r for r in b if r not in set(a)][:3] if len(b) < 20000 else []
        return "DIFF", f"{len(a)} vs {len(b)} rows\n  spark {only_a}\n  sql   {only_b}", took
    return "ok", f"{len(a)} rows", took


def main(folder: str, parts: list[str]) -> int:
    spark = build_session("verify", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    con = connect(folder)
    bad = 0
    for name in registry.QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        status, detail, took = check(spark, con, folder, name)
        bad += status not in ("ok", "rows")
        print(f"{status:6} {name:42} {took:6.2f}s {detail}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.01", args[1:]) else 0)
