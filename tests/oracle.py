"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle.py FOLDER [name ...] [-prefix ...]

A name keeps only the queries named, a prefix leaves out those starting with it.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "item"):
        return plain(v.item())
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder, name, fn, sql):
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "rows-only", len(got), ""
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return "FAIL", len(got), f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3] if len(got) < 50000 else []
        only_want = [r for r in want if r not in set(got)][:3] if len(want) < 50000 else []
        return "FAIL", len(got), f"{len(got)} / {len(want)} rows; spark {only_got} sql {only_want}"
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    types = {c: kinds.get(str(ty), str(ty)) for c, ty in zip(rel.columns, rel.types)}
    diff = {c: (ty, types[c]) for c, ty in df.dtypes if types[c] != ty}
    return "ok", len(got), f"types {diff}" if diff else ""


def main() -> None:
    from firnline.registry import load
    from firnline.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    skipped = [w for w in wanted if w.startswith("-")]
    wanted = [w for w in wanted if not w.startswith("-")]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    queries, oracle = load()
    bad = 0
    for name, fn in queries.items():
        if wanted and name not in wanted or f"-{name.split('_')[0]}" in skipped:
            continue
        t = time.time()
        try:
            state, n, note = compare(spark, con, folder, name, fn, oracle.get(name))
        except Exception as e:  # noqa: BLE001
            state, n, note = "ERROR", 0, str(e)[:6000] if wanted else str(e)[:300]
        bad += state in ("FAIL", "ERROR")
        if state != "ok" or note or n == 0 or time.time() - t > 8 or wanted:
            print(f"{state:9} {name} rows={n} {time.time() - t:.1f}s {note}", flush=True)
    print(f"{len(queries)} queries, {len(oracle)} with SQL, {bad} bad")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
