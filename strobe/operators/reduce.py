"""Capture-mode reductions and acquisition summaries (partial + final aggregates)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.functions.columns import q


def capture_modes(
    samples: DataFrame,
    keys: list[str],
    value: str,
    gate: str | Column,
    order: str,
    prefix: str = "v",
) -> DataFrame:
    """Per group: ``Value`` (last by ``order``), ``Min``, ``Max`` and the gated
    ``Mean`` = sum(x * gate) / sum(gate). All four are algebraic, so Spark
    pre-aggregates map-side and a hot group never lands whole in one task."""
    g = F.col(q(gate)) if isinstance(gate, str) else gate
    x = F.col(q(value))
    return samples.groupBy(*[q(k) for k in keys]).agg(
        F.max_by(x, F.col(q(order))).alias(f"{prefix}_value"),
        F.min(x).alias(f"{prefix}_min"),
        F.max(x).alias(f"{prefix}_max"),
        (F.sum(x * g) / F.sum(g)).alias(f"{prefix}_mean"),
    )


def throughput(acq: DataFrame) -> DataFrame:
    """bytes/s and samples/s per acquisition from samples, sample_bytes and
    duration_s columns."""
    return acq.withColumns(
        {
            "bytes_per_s": F.col("samples") * F.col("sample_bytes") / F.col("duration_s"),
            "samples_per_s": F.col("samples") / F.col("duration_s"),
        }
    )
