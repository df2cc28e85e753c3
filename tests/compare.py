"""Run registered queries next to their DuckDB SQL and compare every value.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(rows: list[tuple], names: list[str]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None:
            return ("", "")
        if isinstance(v, float):
            return ("f", repr(v + 0.0))
        return (type(v).__name__, str(v))

    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out)


def compare(df, con, sql: str) -> list[str]:
    """Differences, empty when the two results are equal."""
    sn, sr = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = con.execute(sql)
    dn, dr = canonical(rel.fetchall(), [d[0] for d in rel.description])
    if sn != dn:
        return [f"columns differ: {sorted(set(sn) ^ set(dn))}"]
    if len(sr) != len(dr):
        return [f"rows {len(sr)} vs {len(dr)}"]
    bad: dict[str, list] = {}
    for a, b in zip(sr, dr):
        for n, x, y in zip(sn, a, b):
            if x != y:
                bad.setdefault(n, []).append((a[sn.index("cust_id")] if "cust_id" in sn else "", x, y))
    return [f"{n}: {len(v)} differ, e.g. {v[:2]}" for n, v in bad.items()]


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.session import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session()
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(qs)
    failed = 0
    for name in wanted:
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in sqls:
                diff = compare(df, con, sqls[name])
                state = "ok" if not diff else "DIFF"
            else:
                diff, state = [], f"rows={len(df.collect())}"
        except Exception as e:  # noqa: BLE001 - report and go on
            diff, state = [str(e)[:600]], "ERROR"
        failed += bool(diff)
        print(f"{name:32s} {state:6s} {time.time() - t:6.2f}s", flush=True)
        for line in diff[:8]:
            print("    ", line[:700], flush=True)
    print("failed:", failed, "of", len(wanted))
