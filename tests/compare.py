"""Driver-style differential check: Spark query vs DuckDB oracle SQL.

Usage: python tests/compare.py [sf_dir] [name-substring ...]
Set COMPARE_JSON=<path> to also write a per-query JSON summary.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) >= 10 and v.isoformat()[10:] in ("", "T00:00:00") else v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
                  "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                  "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN"}


def spark_types(df) -> dict[str, str]:
    out = {}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        out[f.name] = _SPARK_TO_DUCK.get(t, t.upper().replace("DECIMAL", "DECIMAL"))
    return out


def oracle_types(con, sql: str) -> dict[str, str]:
    rel = con.sql(sql)
    return {c: str(t) for c, t in zip(rel.columns, rel.types)}


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    picks = argv[2:]
    import __spark_entry__ as E
    from tierwise.session import build_session
    spark = build_session(extra={"spark.driver.memory": os.environ.get("COMPARE_DRIVER_MEMORY", "4g"),
                                 "spark.driver.maxResultSize": "0"})
    con = oracle_connection(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    report = {}
    for name, fn in qs.items():
        if picks and not any(p in name for p in picks):
            continue
        t = time.time()
        df = fn(spark, sf_dir)
        cols = df.columns
        srows = [tuple(r) for r in df.collect()]
        ts = time.time() - t
        if name not in sql:
            print(f"{name:40s} spark={len(srows):7d} (no oracle) {ts:.2f}s")
            continue
        res = con.execute(sql[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        hs, ls = digest(cols, srows)
        ho, lo = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
        st, ot = spark_types(df), oracle_types(con, sql[name])
        type_diff = {c: (st[c], ot.get(c)) for c in st if st[c] != ot.get(c)}
        bad += not ok
        report[name] = {"rows": len(srows), "oracle_rows": len(orows), "match": ok, "types_match": not type_diff,
                        "seconds": round(ts, 3)}
        print(f"{name:40s} spark={len(srows):7d} oracle={len(orows):7d} {'OK ' if ok else 'BAD'} {ts:.2f}s"
              + (f"  types differ: {type_diff}" if type_diff else ""))
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   cols", sorted(cols), sorted(ocols))
            sd, od = set(ls), set(lo)
            print("   spark-only", sorted(sd - od)[:4])
            print("   oracle-only", sorted(od - sd)[:4])
    print("mismatches:", bad)
    if os.environ.get("COMPARE_JSON"):
        import json
        with open(os.environ["COMPARE_JSON"], "w") as fh:
            json.dump({"sf_dir": sf_dir, "mismatches": bad, "queries": report}, fh, indent=1)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
