"""The period book as a stream: late rows within the watermark are counted, a period is emitted once it is past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from creditloom.functions.exprs import count_if


def stream_book(events: DataFrame, ts: str, state: Column, states: list[int], length: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """Rows and counts by state of each window of time."""
    rows = events.withColumn("_state", state).withWatermark(ts, lateness)
    out = rows.groupBy(F.window(ts, length).alias("w")).agg(F.count("*").alias("rows"), *(count_if(F.col("_state") == s).alias(f"rows_{s}") for s in states))
    return out.select(F.col("w.start").alias("period"), "rows", *(f"rows_{s}" for s in states))


def write_book(book: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished periods to parquet, exactly once by the checkpoint."""
    return book.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
