"""Run registered queries against their oracle SQL: ``python -m checks.compare [sf] [name …]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from orderloom.session import local_session

from . import load_all
from .registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_bool_dtype(df[c]) or df[c].dtype == object and df[c].dropna().map(lambda v: isinstance(v, bool)).all():
            df[c] = df[c].map(lambda v: None if pd.isna(v) else str(bool(v)))
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64").round(6).map(lambda v: None if pd.isna(v) else repr(v))
        elif pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].map(lambda v: None if pd.isna(v) else str(v)[:26])
        else:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)) or v is pd.NaT else str(v))
            if df[c].dropna().map(lambda v: len(v) == 10 and v[4] == "-").all():
                df[c] = df[c].map(lambda v: None if v is None else v + " 00:00:00" if len(v) == 10 and v[4:5] == "-" else v)
    df = df.fillna("\0")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def main() -> int:
    load_all()
    args = sys.argv[1:]
    folder = f"/root/testdata/{args[0] if args else 'sf0.01'}"
    names = args[1:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        started = time.time()
        try:
            result = QUERIES[name](spark, folder)
            types = {f.name: f.dataType.simpleString() for f in result.schema.fields}
            got = result.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: {str(e)[:1500]}")
            bad += 1
            continue
        took = time.time() - started
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} in {took:.1f}s")
            continue
        try:
            want = con.execute(ORACLES[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"ORACLE {name}: {str(e)[:1500]}")
            bad += 1
            continue
        if sorted(got.columns) != sorted(want.columns):
            print(f"COLUMNS {name}: {sorted(got.columns)} / {sorted(want.columns)}")
            bad += 1
            continue
        kinds = dict(zip(want.columns, want.dtypes.astype(str)))
        a, b = normal(got), normal(want)
        if len(a) != len(b) or not a.equals(b):
            print(f"DIFF {name}: {len(a)} / {len(b)} rows")
            merged = a.merge(b, how="outer", indicator=True)
            print(merged[merged["_merge"] != "both"].head(8).to_string())
            bad += 1
        else:
            odd = [c for c in types if (types[c] in ("string",)) != (kinds[c] in ("object", "str"))
                   and types[c] not in ("boolean", "date", "timestamp", "timestamp_ntz")
                   or types[c] == "int" and "32" not in kinds[c] or types[c] == "bigint" and "64" not in kinds[c]]
            print(f"ok {name}: {len(a)} rows {took:.1f}s" + (f" TYPES {[(c, types[c], kinds[c]) for c in odd]}" if odd else ""))
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
