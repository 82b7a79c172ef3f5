"""Order-insensitive comparison of two result frames (column names sorted)."""

from __future__ import annotations

import math

import pandas as pd


def _cell(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() and abs(v) < 2**53 else round(v, 6)
    if hasattr(v, "item"):
        return _cell(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_cell(v) for v in r) for r in df[cols].itertuples(index=False)]
    return sorted(rows, key=lambda t: tuple((x is None, type(x).__name__, x if x is not None else 0) for x in t))


def same(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    return sorted(a.columns) == sorted(b.columns) and normalise(a) == normalise(b)
