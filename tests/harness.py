"""Compare a registered query with its SQL statement in DuckDB.

    python tests/harness.py [--sf DIR] [--bucket ROWS] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def difference(got, want):
    """None when equal, else a short description."""
    (gn, gr), (wn, wr) = got, want
    if gn != wn:
        return f"columns {gn} != {wn}"
    if len(gr) != len(wr):
        return f"rows {len(gr)} != {len(wr)}; spark {gr[:2]!r}; sql {wr[:2]!r}"
    for a, b in zip(gr, wr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference:\n  spark {a!r}\n  sql   {b!r}"[:3000]
    return None


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf_dir, argv = argv[1], argv[2:]
    from corpusloom import plans
    from corpusloom.operators import prefix

    if argv[:1] == ["--bucket"]:
        prefix.ROWS_PER_BUCKET, argv = int(argv[1]), argv[2:]
    from corpusloom.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = []
    for name in argv or plans.QUERIES:
        t = time.time()
        try:
            got = spark_rows(plans.QUERIES[name](spark, sf_dir))
            t1 = time.time()
            if name not in plans.ORACLE:
                print(f"rows {name}: {len(got[1])} rows, {t1 - t:.2f}s  e.g. {got[1][:1]!r}"[:400], flush=True)
                continue
            diff = difference(got, duck_rows(con, plans.ORACLE[name]))
            t2 = time.time()
        except Exception as e:  # noqa: BLE001
            diff, t1, t2 = f"{type(e).__name__}: {str(e)[:1500]}", time.time(), time.time()
            got = (None, [])
        if diff:
            bad.append(name)
            print(f"FAIL {name}: {diff}", flush=True)
        else:
            print(f"ok   {name}: {len(got[1])} rows, spark {t1 - t:.2f}s, sql {t2 - t1:.2f}s", flush=True)
    print("failed:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
