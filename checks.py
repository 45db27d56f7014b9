"""Compare the registered queries with their SQL in DuckDB: `python checks.py [name ...]`.

SF_DIR chooses the data. Prints one line per query; exit code 1 on any difference.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

from cargotide.plans.catalog import load
from cargotide.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "HUGEINT": "hugeint", "DOUBLE": "double", "VARCHAR": "string",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(rows, names, order):
    take = [names.index(c) for c in order]
    return sorted((tuple(repr(row[k]) for k in take) for row in rows))


def compare(df, con, text) -> str:
    rel = con.sql(text)
    names, kinds = rel.columns, [str(t) for t in rel.types]
    wanted = rel.fetchall()
    got = [tuple(row) for row in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns differ {sorted(df.columns)} / {sorted(names)}"
    order = sorted(names)
    spark_types = dict(df.dtypes)
    odd = [f"{c}:{spark_types[c]}/{TYPES.get(k, k)}" for c, k in zip(names, kinds)
           if spark_types[c] != TYPES.get(k, k)]
    if len(got) != len(wanted):
        return f"rows {len(got)} / {len(wanted)}"
    a, b = canonical(got, df.columns, order), canonical(wanted, names, order)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {dict(zip(order, bad[0][0]))} / {dict(zip(order, bad[0][1]))}"
    return f"ok {len(got)} rows" + (f"  TYPES {odd}" if odd else "")


def main(names: list[str]) -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    queries, oracles = load()
    spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf_dir), 0
    for name, fn in queries.items():
        if names and not any(name == n or name.startswith(n if len(n) == 1 else n + "_") for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                message = compare(df, con, oracles[name])
            else:
                message = f"ok {len(df.collect())} rows (no SQL)"
        except Exception as error:  # report and go on
            message = f"ERROR {type(error).__name__} {str(error)[:600]}"
        failed += not message.startswith("ok") or "TYPES" in message
        print(f"{name:40s} {time.time() - start:6.2f}s {message}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
