"""Streaming change feed: latest value per field (update mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.operators.state import classify_change


def latest_values_stream(lines: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Change lines (keys, seq, line) -> (keys, field, latest) for value lines.

    ``max_by`` keeps (value, seq) per field in the state store, so a line that
    arrives in a later micro-batch with a higher ``seq`` replaces the value
    and an older one does not; run it in ``update`` output mode.
    """
    cls = classify_change(F.col("line"))
    parsed = lines.select(*keys, seq, cls["kind"].alias("kind"), cls["key"].alias("field"), cls["value"].alias("value"))
    return (
        parsed.where(F.col("kind") == "value")
        .groupBy(*keys, "field")
        .agg(F.max_by("value", F.col(seq)).alias("latest"))
    )
