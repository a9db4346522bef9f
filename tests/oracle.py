"""Run a registered query and its SQL on the same tables and report differences."""

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal; otherwise the first difference."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    got, want = normal(got), normal(want)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and len(got)}
    if odd:
        return f"types {odd}"
    for c in got.columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {(~same).sum()} differ, first\n{got.loc[at].to_dict()}\n{want.loc[at].to_dict()}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from airloom.session import local_session

    sf_dir, patterns = sys.argv[1], sys.argv[2:]
    spark = local_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("MAX_STATION_ROWS"):
        spark.conf.set("airloom.maxStationRows", os.environ["MAX_STATION_ROWS"])
    con, sql = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if patterns and not any(name.startswith(p) for p in patterns):
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - start
            why = compare(got, con.execute(sql[name]).df()) if name in sql else "(rows only)"
        except Exception as e:  # noqa: BLE001
            took, why, got = time.time() - start, f"ERROR {str(e)[:1500]}", []
        bad += bool(why) and why != "(rows only)"
        print(f"{name:45s} {took:6.2f}s rows={len(got)} {why or 'ok'}", flush=True)
    print("bad:", bad)
