"""Run queries in Spark and their SQL in DuckDB and compare schema and rows.

usage: python tools/compare.py [scale] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import pathlib
import sys
import time
import traceback
from collections import Counter

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from haulmark import catalog  # noqa: E402
from haulmark.catalog.q_sources import TABLES  # noqa: E402
from haulmark.session import build_session  # noqa: E402

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(spark, con, folder: str, name: str) -> list[str]:
    """What differs between the two engines for one query; empty if nothing does."""
    df = catalog.all_queries()[name](spark, folder)
    sql = catalog.all_sql().get(name)
    names = sorted(df.columns)
    got = Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    if sql is None:
        return [] if got else ["no rows"]
    con.execute(sql)
    columns = {c[0]: str(t) for c, t in zip(con.description, [d[1] for d in con.description])}
    found = []
    if sorted(columns) != names:
        return [f"columns {names} against {sorted(columns)}"]
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    found += [f"type of {c}: {types[c]} against {columns[c]}" for c in names if types[c] != columns[c]]
    order = [list(columns).index(c) for c in names]
    want = Counter(tuple(_plain(r[i]) for i in order) for r in con.fetchall())
    if got != want:
        extra, lacking = got - want, want - got
        found.append(f"rows {sum(got.values())} against {sum(want.values())}; "
                     f"{sum(extra.values())} only in Spark, {sum(lacking.values())} only in SQL")
        found.append(f"columns {names}")
        found += [f"  spark {r}" for r in sorted(extra, key=str)[:3]]
        found += [f"  sql   {r}" for r in sorted(lacking, key=str)[:3]]
    elif not got:
        found.append("no rows in either engine")
    return found


def main() -> int:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or catalog.all_queries():
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as error:  # report and go on with the other queries
            found = [str(error)[:1500] or traceback.format_exc()[-1500:]]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     " + line)
    print(f"{bad} of {len(sys.argv[2:] or catalog.all_queries())} differ")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
