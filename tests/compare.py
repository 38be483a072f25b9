"""Run registered queries on Spark and their comparison SQL on DuckDB and compare all rows.

    python -m tests.compare [--sql] <folder> [name part ...]

``--sql`` leaves out the queries without comparison SQL.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v if v is None or isinstance(v, (bool, str)) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, query, sql: str | None):
    """(ok, row count, note)"""
    df = query(spark, folder)
    names, got = rows_of(df.columns, df.collect())
    n = sum(got.values())
    if sql is None:
        return True, n, "no SQL"
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_names, want = rows_of(list(kinds), cur.fetchall())
    if names != want_names:
        return False, n, f"columns {names} / {want_names}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = [f"{c}: {types[c]} / {kinds[c]}" for c in names if (types[c], kinds[c]) not in SAME_TYPE]
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return False, n, f"{n} rows / {sum(want.values())}; only Spark {extra}; only SQL {missing}"
    return True, n, ("types " + ", ".join(odd)) if odd else ""


SAME_TYPE = {
    ("bigint", "BIGINT"), ("int", "INTEGER"), ("string", "VARCHAR"), ("double", "DOUBLE"), ("boolean", "BOOLEAN"),
    ("date", "DATE"), ("timestamp_ntz", "TIMESTAMP"), ("timestamp", "TIMESTAMP"), ("array<string>", "VARCHAR[]"),
}


def main() -> None:  # noqa: D103
    import __spark_entry__ as entry
    from ticketry.session import get_spark

    args = [a for a in sys.argv[1:] if a != "--sql"]
    folder, parts = args[0], args[1:]
    spark = get_spark("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if (parts and not any(p in name for p in parts)) or ("--sql" in sys.argv and name not in sqls):
            continue
        start = time.time()
        try:
            ok, n, note = compare(spark, con, folder, query, sqls.get(name))
        except Exception as err:  # report and go on with the next query
            ok, n, note = False, -1, f"{type(err).__name__}: {str(err).replace(chr(10), " ")[:4000]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:42s} {n:8d} rows {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
