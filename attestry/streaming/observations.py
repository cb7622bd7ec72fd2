"""Late evidence as a stream: what was usable when, kept as evidence arrives.

The batch engine answers from all evidence known by a date. The same bucket is kept here for
a stream of observations: per series and day of retrieval, how many arrived in time of a
cut-off and how many later; a watermark bounds the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def arrivals(observations: DataFrame, series: str, at: str, known_at: str, delay: str = "7 days") -> DataFrame:
    """Counts of usable and later observations a series and day; works on streams and tables."""
    usable = F.col(at) <= F.lit(known_at).cast("timestamp")
    seen = observations.withWatermark(at, delay) if observations.isStreaming else observations
    return seen.groupBy(series, F.window(at, "1 day")).agg(F.count_if(usable).alias("usable"), F.count_if(~usable).alias("after_k")).select(
        series, F.to_date("window.start").alias("day"), "usable", "after_k"
    )
