"""Run queries next to their SQL and compare the rows. ``python tests/oracle.py [sf dir] [names...]``"""

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(value)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    mine = canon(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"{len(mine[1])} rows, no SQL"
    cur = con.execute(sql)
    theirs = canon([c[0] for c in cur.description], cur.fetchall())
    assert mine[0] == theirs[0], f"columns {mine[0]} != {theirs[0]}"
    assert len(mine[1]) == len(theirs[1]), f"rows {len(mine[1])} != {len(theirs[1])}\n{mine[1][:3]}\n{theirs[1][:3]}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    assert not bad, f"{len(bad)} of {len(mine[1])} rows differ in {mine[0]}, first:\n{bad[0][0]}\n{bad[0][1]}"
    return f"{len(mine[1])} rows"


if __name__ == "__main__":
    from gaugeloom.queries import ORACLES, QUERIES
    from gaugeloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    session = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf), []
    for n in chosen:
        began = time.time()
        try:
            print(f"ok   {n}: {compare(session, db, n, QUERIES[n], ORACLES.get(n), sf)} {time.time() - began:.1f}s", flush=True)
        except Exception as err:
            failed.append(n)
            text = str(err).split("JVM stacktrace")[0][:900]
            print(f"FAIL {n}: {type(err).__name__} {text}", flush=True)
            if "-v" in os.environ.get("FLAGS", ""):
                traceback.print_exc()
    print(f"{len(chosen) - len(failed)} of {len(chosen)} agree; failed: {failed}")
