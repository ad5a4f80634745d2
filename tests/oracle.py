"""Side-by-side check of registered queries: Spark result against the SQL text run by DuckDB.

``python -m tests.oracle [sf_dir] [name…]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

import __spark_entry__ as entry_points

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    cell = lambda v: "∅" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else (f"{v:.6f}" if isinstance(v, float) else str(v))
    clean = lambda v: v.item() if hasattr(v, "item") else v
    return sorted(tuple(cell(clean(v)).replace("-0.000000", "0.000000") for v in row) for row in frame.itertuples(index=False))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    result = entry_points.queries()[name](spark, sf_dir)
    got = result.toPandas()
    for column, kind in result.dtypes:
        if kind in ("bigint", "int") and got[column].dtype == "float64":  # whole numbers with nulls
            got[column] = got[column].astype("Int64")
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return len(got) > 0, f"rows-only rows={len(got)}"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = canonical(got), canonical(want)
    if left == right:
        return len(left) > 0, f"rows={len(left)}"
    extra = [r for r in left if r not in set(right)][:3]
    missing = [r for r in right if r not in set(left)][:3]
    return False, f"rows {len(left)} vs {len(right)}; spark only {extra}; sql only {missing}; types {dict(got.dtypes)} / {dict(want.dtypes)}"


def main(argv: list[str]) -> int:
    from adweave.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    names = list(entry_points.queries())
    wanted = argv[1:]
    if wanted:
        names = [n for n in names if any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
