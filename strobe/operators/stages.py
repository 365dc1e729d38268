"""User stages over capture messages: the DataFrame form of a chain of
processing elements.

A stage is a ``DataFrame -> DataFrame`` function; stages for one message kind
(``header``, ``frame``, ``end``) are chained with ``DataFrame.transform``. A
stage that filters rows out ends the chain for them. Side effects (metrics,
notifications) belong in ``foreachBatch`` of a streaming query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]


def chain(df: DataFrame, *stages: Stage) -> DataFrame:
    return reduce(lambda acc, stage: acc.transform(stage), stages, df)


def by_kind(messages: DataFrame, stages: dict[str, list[Stage]]) -> dict[str, DataFrame]:
    """Route index/stream rows by ``kind`` and run each kind's stage chain."""
    return {kind: chain(messages.where(F.col("kind") == kind), *fns) for kind, fns in stages.items()}
