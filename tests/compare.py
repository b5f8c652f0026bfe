"""Run a query and its SQL text side by side and compare all values."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def run_sql(folder: str, text: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection.execute(text).df()


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for name in pdf.columns:
        if pdf[name].dtype.kind in "iub":
            pdf[name] = pdf[name].astype("int64")
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def differences(df: DataFrame, expected: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    got = df.toPandas()
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    odd = [(c, got[c].dtype, expected[c].dtype) for c in got.columns if got[c].dtype != expected[c].dtype]
    if odd:
        return f"types {odd}"
    got, expected = _ordered(got), _ordered(expected)
    for name in got.columns:
        left, right = got[name], expected[name]
        same = (left == right) | (left.isna() & right.isna())
        if not same.all():
            at = same[~same].index[:3].tolist()
            return f"{name}: {int((~same).sum())} of {len(got)} differ, e.g. {left[at].tolist()} != {right[at].tolist()}"
    return None
