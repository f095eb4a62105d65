"""What a query's physical plan holds."""

from __future__ import annotations

from pyspark.sql import DataFrame


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan of ``df`` as it stands before it runs; broadcasts don't count."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum(1 for line in lines if "Exchange " in line and "BroadcastExchange" not in line)
