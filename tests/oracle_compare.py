"""Run registered queries in Spark and their DuckDB twins; compare like the driver does
(row count, sorted column names and types, order-insensitive values).

    python tests/oracle_compare.py [SF_DIR] [QUERY ...] [--json REPORT.json]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections import Counter

import duckdb

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


_SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
                  "timestamp_ntz": "TIMESTAMP"}


def rows_of_spark(df):
    cols = sorted(df.columns)
    types = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    return cols, [types[c] for c in cols], [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    types = [str(rel.types[i]) for i in idx]
    return cols, types, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def compare(spark, con, name, fn, sql, sf_dir):
    scols, stypes, srows = rows_of_spark(fn(spark, sf_dir))
    dcols, dtypes, drows = rows_of_duck(con, sql)
    problems = []
    if scols != dcols:
        problems.append(f"columns spark={scols} duck={dcols}")
    elif stypes != dtypes:
        diff = [(c, a, b) for c, a, b in zip(scols, stypes, dtypes) if a != b]
        problems.append(f"types differ {diff}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        cs, cd = Counter(srows), Counter(drows)
        if cs != cd:
            only_s = list((cs - cd).elements())[:3]
            only_d = list((cd - cs).elements())[:3]
            problems.append(f"values differ: spark-only {only_s} duck-only {only_d}")
    return len(srows), problems


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from sheetfold.session import build_session

    report_path = None
    if "--json" in argv:
        k = argv.index("--json")
        report_path = argv[k + 1]
        argv = argv[:k] + argv[k + 2:]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    report = {}
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duck_conn(sf_dir)
    qs, osql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in osql:
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} rows-only {n}")
            continue
        try:
            n, problems = compare(spark, con, name, fn, osql[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            n, problems = -1, [f"error {type(e).__name__}: {str(e)[:400]}"]
        bad += bool(problems)
        report[name] = {"rows": n, "match": not problems, "problems": problems}
        print(f"{name:28s} {'OK ' if not problems else 'BAD'} {n} {'; '.join(problems)}")
    print(f"{len(qs)} queries, {len(osql)} with oracle, {bad} mismatched")
    if report_path:
        import json
        with open(report_path, "w", encoding="utf-8") as f:
            json.dump({"sf_dir": sf_dir, "queries": report, "mismatched": bad}, f, indent=1, sort_keys=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
