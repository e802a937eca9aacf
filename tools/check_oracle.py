"""Run every query and its SQL on the same tables and compare all values.

usage: python tools/check_oracle.py [FOLDER] [QUERY ...] [--no-broadcast]

With --no-broadcast every join of tables takes its shuffle plan, as it would
with tables beyond the broadcast limit.
"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from tillsight import oracle, registry  # noqa: E402
from tillsight.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v).__name__), v) if v is not None else (False, "", 0)
                 for v in row)


def compare(spark, con, folder: str, name: str, sql: str) -> str:
    """Empty when columns, types and all values agree exactly."""
    frame = registry.QUERIES[name](spark, folder)
    order = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*[f"`{c}`" for c in order]).collect()]
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != order:
        return f"columns {order} != {sorted(columns)}"
    place = [columns.index(c) for c in order]
    want = [tuple(r[i] for i in place) for r in want]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got.sort(key=_sortable)
    want.sort(key=_sortable)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, columns {order}, first {bad[0]}"
    kinds = {(type(a), type(b)) for g, w in zip(got[:50], want[:50]) for a, b in zip(g, w)
             if a is not None and type(a) is not type(b)}
    return f"types differ: {kinds}" if kinds else ""


def main() -> int:
    names = [a for a in sys.argv[1:] if not a.startswith("--")]
    folder, wanted = (names[0], names[1:]) if names else ("/root/testdata/sf0.01", [])
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} \
        if "--no-broadcast" in sys.argv else {}
    spark, con, sql = local_session("check", **limits), connect(folder), oracle.statements()
    missing = set(registry.QUERIES) ^ set(sql)
    failed = 0
    for name, text in sql.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, text)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += bool(problem)
        if problem or wanted:
            print(f"{name}: {problem or 'same'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{len(sql)} queries with SQL, {failed} differ, without counterpart: {sorted(missing)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
