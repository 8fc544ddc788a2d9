"""Join helper: broadcast a dimension only where its size is bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "left", bounded: bool = False) -> DataFrame:
    """Fact-to-dimension join.  The caller states that the dimension is bounded
    by construction; otherwise Spark's own byte-size check decides."""
    return fact.join(F.broadcast(dim) if bounded else dim, on, how)
