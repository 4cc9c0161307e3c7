"""The monthly mean of observations as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_mean_stream(observations: DataFrame, area: str, time: str, value: str, late: str = "40 days", scale: float = 1.0) -> DataFrame:
    """Mean per area and month, scaled; state of a month is let go ``late`` after its end, so it stays bounded.

    Works on a stream and, with the same result, on a table. Rows without a time are left out.
    """
    seen = observations.filter(F.col(time).isNotNull()).withWatermark(time, late) if observations.isStreaming else observations.filter(F.col(time).isNotNull())
    month = F.date_trunc("month", F.col(time)).alias("month")
    return seen.groupBy(area, month).agg((F.avg(value) * scale).alias("mean"), F.count("*").alias("n"))
