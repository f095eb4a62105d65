"""Sliding totals per customer on event time, as sales arrive.

A window is closed, and written once, when the watermark has passed its end: the newest event time seen so far, less ``late_days``.
Until then late sales still count in it. A sale later than that is dropped by the window operator, and ``dropped`` tells how
many (customer, window) updates were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

SECONDS = 86_400


def instant(day: Column) -> Column:
    """Midnight UTC of a date, whatever the session's time zone: windows are aligned to days since 1970-01-01."""
    return F.timestamp_seconds(F.unix_date(day) * SECONDS)


def day_of(moment: Column) -> Column:
    return F.date_from_unix_date((F.unix_seconds(moment) / SECONDS).cast("int"))


def sliding_sales(sales: DataFrame, length_days: int = 30, slide_days: int = 30, late_days: int = 7) -> DataFrame:
    """CustomerID, WindowStart, WindowEnd (the day after the last), Lines and Spend. ``sales``: a stream, or a table."""
    dated = sales.filter("CustomerID is not null and TransactionDate is not null").select(
        "CustomerID", "LineTotal", instant(F.col("TransactionDate")).alias("EventTime"))
    if sales.isStreaming:
        dated = dated.withWatermark("EventTime", f"{late_days} days")
    span = F.window("EventTime", f"{length_days} days", f"{slide_days} days")
    totals = dated.groupBy("CustomerID", span.alias("w")).agg(F.count(F.lit(1)).alias("Lines"), F.sum("LineTotal").alias("Spend"))
    return totals.select("CustomerID", day_of(F.col("w.start")).alias("WindowStart"), day_of(F.col("w.end")).alias("WindowEnd"), "Lines", "Spend")


def start_sliding_sales(sales: DataFrame, path: str, checkpoint: str, length_days: int = 30, slide_days: int = 30,
                        late_days: int = 7) -> StreamingQuery:
    """Write the windows that close with what has arrived by now; started again, it goes on from the checkpoint."""
    return (sliding_sales(sales, length_days, slide_days, late_days).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def dropped(query: StreamingQuery) -> int:
    """Updates of closed windows that the query refused in its kept progress reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
