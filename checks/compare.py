"""Run registered queries beside their SQL in DuckDB and compare all rows.

python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from checks.registry import oracle_sql, queries
from wattline.session import build_session


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].isna().all():
            df[c] = float("nan")
        elif pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_bool_dtype(df[c]) or df[c].dropna().map(type).eq(bool).all():
            df[c] = df[c].astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, expected: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(set(got.columns) ^ set(expected.columns))}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    try:
        pd.testing.assert_frame_equal(normal(got), normal(expected), check_dtype=False, rtol=0, atol=1e-9)
    except AssertionError as error:
        return " ".join(str(error).split())[:400]
    return "ok"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - start
            verdict = compare(got, con.execute(texts[name]).df()) if name in texts else "rows only"
            if len(got) == 0:
                verdict += " (EMPTY)"
        except Exception as error:  # report and go on with the next query
            got, took, verdict = (), time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {len(got):7d} rows {took:6.1f} s  {verdict}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
