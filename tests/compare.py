"""Run queries and their SQL twins side by side.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return round(float(value), 6)


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def compare(df, con, twin: str) -> str:
    """Empty when both sides agree, else what differs."""
    ours = df.collect()
    got = con.execute(twin)
    names = [c[0] for c in got.description]
    theirs = got.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows(df.columns, ours), rows(names, theirs)
    if a == b:
        types = {n: str(t) for n, t in zip(names, (c[1] for c in got.description))}
        odd = [n for n, t in types.items() if "HUGEINT" in t or "DECIMAL" in t]
        return f"types {odd}" if odd else ""
    return f"rows {len(ours)} / {len(theirs)}: only ours {list((a - b).items())[:2]}, only twin {list((b - a).items())[:2]}"


def main() -> None:
    import __spark_entry__ as entry
    from session import session
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), database(sf_dir)
    twins = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            note = compare(df, con, twins[name]) if name in twins else f"no twin, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            note = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        bad += note.startswith(("rows", "FAILED", "columns", "types"))
        print(f"{name:32s} {time.time() - start:6.1f}s {note or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
