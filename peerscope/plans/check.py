"""Local stand-in for the driver's correctness gate: run a registered query in Spark and
its oracle SQL in DuckDB over the same parquet files; compare row count, column names
and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib

import pandas as pd

from peerscope.sources.testdata import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _is_na(v) -> bool:
    try:
        return v is None or bool(pd.isna(v))
    except (TypeError, ValueError):
        return False


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if _is_na(v) else str(v))
        df[c] = df[c].map(lambda v: v[:-2] if isinstance(v, str) and v.endswith(".0") else v)
        df[c] = df[c].map(lambda v: v[:-9] if isinstance(v, str) and v.endswith(" 00:00:00") else v)
    return df


def digest(df: pd.DataFrame) -> str:
    rows = sorted("|".join("\\N" if v is None else v for v in r) for r in _norm(df).itertuples(index=False))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> dict:
    out = {
        "rows": (len(spark_df), len(oracle_df)),
        "columns_match": sorted(spark_df.columns) == sorted(oracle_df.columns),
    }
    out["match"] = out["columns_match"] and len(spark_df) == len(oracle_df) and digest(spark_df) == digest(oracle_df)
    if out["columns_match"] and not out["match"]:
        a, b = _norm(spark_df), _norm(oracle_df)
        for c in a.columns:
            if sorted(a[c].fillna("\\N")) != sorted(b[c].fillna("\\N")):
                out.setdefault("differing_columns", []).append(c)
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(spark_df.columns) - set(oracle_df.columns))
        out["oracle_only"] = sorted(set(oracle_df.columns) - set(spark_df.columns))
    return out
