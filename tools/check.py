"""Run registered queries against their SQL checks: python tools/check.py [sf] [name ...]"""

from __future__ import annotations

import importlib
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from duewise.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted: what an order-free value hash sees."""
    def text(v):
        if isinstance(v, (list, tuple, np.ndarray)):
            return repr([text(x) for x in v])
        if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
            return "~"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, np.integer)):
            return repr(float(v))
        if isinstance(v, (float, np.floating)):
            return repr(float(v))
        return str(v)

    out = frame[sorted(frame.columns)].map(text) if len(frame) else frame[sorted(frame.columns)]
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    entry = importlib.import_module("__spark_entry__")
    queries, checks = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = local_session()
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = []
    for name in names:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            rows = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns, dtype=object)
            took = time.time() - started
            if name not in checks:
                print(f"rows  {name:34s} {len(rows):8d} {took:6.1f}s", flush=True)
                continue
            started = time.time()
            cursor = db.execute(checks[name])
            expected = pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object)
            sql_took = time.time() - started
            a, b = normal(rows), normal(expected)
            if list(a.columns) != list(b.columns):
                bad.append(name)
                print(f"FAIL  {name}: columns differ {sorted(set(a.columns) ^ set(b.columns))}", flush=True)
            elif len(a) != len(b) or not a.equals(b):
                bad.append(name)
                print(f"FAIL  {name}: rows {len(a)} / {len(b)}", flush=True)
                left = pd.concat([a.assign(side="spark"), b.assign(side="sql")]).drop_duplicates(list(a.columns), keep=False)
                for c in a.columns:
                    if len(a) == len(b) and not a[c].sort_values().reset_index(drop=True).equals(b[c].sort_values().reset_index(drop=True)):
                        print("      differs in", c)
                print(left.sort_values(list(a.columns)).head(6).to_string(max_colwidth=40))
            else:
                print(f"ok    {name:34s} {len(rows):8d} {took:6.1f}s  sql {sql_took:5.1f}s", flush=True)
        except Exception as error:  # report and go on with the next query
            bad.append(name)
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
