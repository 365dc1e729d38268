"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import math

import pandas as pd


def _norm(v):
    if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v) is True):
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canonical(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in rec) for rec in df[cols].itertuples(index=False)]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return cols, sorted(out, key=key)


def same_result(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> tuple[bool, str]:
    sc, sr = canonical(spark_df)
    oc, orow = canonical(oracle_df)
    if sc != oc:
        return False, f"columns {sc} != {oc}"
    if len(sr) != len(orow):
        return False, f"rows {len(sr)} != {len(orow)}"
    if sr != orow:
        extra = [r for r in sr if r not in set(orow)][:3]
        missing = [r for r in orow if r not in set(sr)][:3]
        return False, f"spark-only {extra} oracle-only {missing}"
    return True, ""
