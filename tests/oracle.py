"""Side-by-side comparison of a registered query and its SQL text."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i].lower() for i in order], sorted(table, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL result; empty when equal."""
    names, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    other, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != other:
        return [f"columns differ: only spark {sorted(set(names) - set(other))[:5]}, only sql {sorted(set(other) - set(names))[:5]}"]
    if len(got) != len(want):
        return [f"{len(got)} rows, expected {len(want)}"]
    bad = []
    for a, b in zip(got, want, strict=True):
        for n, x, y in zip(names, a, b, strict=True):
            if x != y:
                bad.append(f"{n}: {x!r} vs {y!r}")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from riskloom.queries import ORACLES, QUERIES
    from riskloom.session import local_session

    folder, *wanted = sys.argv[1:]
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name, run in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                bad = compare(df, con, ORACLES[name])
                note = "ok" if not bad else f"DIFF {len(bad)} {bad[:4]}"
            else:
                note = f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            note = f"ERROR {str(e)[:400]}"
        print(f"{name:35s} {time.time() - start:6.1f}s {note}", flush=True)
