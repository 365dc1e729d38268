"""Registry of check queries: name -> (builder(spark, sf_dir), oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    from strobe.plans import capture_queries, config_queries, control_queries, metadata_queries  # noqa: F401
