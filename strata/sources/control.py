"""Control-plane scans (run events / folded runs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def control_runs(runs: DataFrame, module: str | None = None, status: str | None = None) -> DataFrame:
    out = runs
    if module is not None:
        out = out.filter(F.col("module_name") == module)
    if status is not None:
        out = out.filter(F.col("status") == status)
    return out
