"""Compare registered queries with their SQL on DuckDB.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _normal(value):
    if isinstance(value, float):
        return repr(value + 0.0) if value == value else "nan"
    if value is None:
        return "\x00null"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_normal(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns: only spark {set(got_cols) - set(want_cols)}, only sql {set(want_cols) - set(got_cols)}"
    if len(got) != len(want):
        return f"rows: spark {len(got)}, sql {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if not bad:
        return None
    a, b = bad[0]
    cells = [f"{c}: spark={x!r} sql={y!r}" for c, x, y in zip(got_cols, a, b) if x != y]
    return f"{len(bad)} of {len(got)} rows; " + "; ".join(cells[:6])


def main() -> int:
    import __spark_entry__ as entry
    from clinlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, sql, failed = local_session(), duck(sf), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            note = difference(df, con, sql[name]) if name in sql else f"no sql, {df.count()} rows"
        except Exception as error:
            note = "ERROR " + str(error).replace("\n", " ")[:700]
        bad = note is not None and not note.startswith("no sql")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.time() - start:.1f}s {note or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
