"""Streaming capture-mode reduction over event-time windows (watermarked)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.functions.columns import q


def windowed_capture_modes(
    samples: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    gate: str | Column,
    window: str,
    watermark: str,
    order: str | None = None,
) -> DataFrame:
    """Per key and tumbling window of ``ts``: Value (last), Min, Max and the
    gated Mean sum(x*g)/sum(g). With a watermark the state of closed windows
    is dropped and, in append mode, each window is emitted once when it closes.
    """
    g = F.col(q(gate)) if isinstance(gate, str) else gate
    x = F.col(q(value))
    last_by = F.col(q(order)) if order else F.col(ts)
    return (
        samples.withWatermark(ts, watermark)
        .groupBy(*[q(k) for k in keys], F.window(ts, window).alias("window"))
        .agg(
            F.max_by(x, last_by).alias("v_value"),
            F.min(x).alias("v_min"),
            F.max(x).alias("v_max"),
            (F.sum(x * g) / F.sum(g)).alias("v_mean"),
        )
    )
