"""Resampling of cells that arrive over time, with a bound on how late they may be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.resample import AGGREGATES, Columns, as_timestamp, detect

WINDOWS = {"hour": "1 hour", "day": "1 day", "week": "1 week"}
#: A week's windows start on Monday; the epoch was a Thursday.
OFFSETS = {"week": "4 days"}
#: Aggregates whose state is bounded per window.
BOUNDED = ("sum", "avg", "mean", "min", "max", "count", "stddev", "variance")


def resample_stream(df: DataFrame, freq: str, agg: str, lateness: str = "1 hour", columns: Columns | None = None) -> DataFrame:
    """time, lat, lon, value of each window, which a watermark closes; rows that are later are dropped."""
    if freq not in WINDOWS:
        raise ValueError(f"no frequency {freq!r} over streams; there are {', '.join(WINDOWS)}")
    if agg not in BOUNDED:
        raise ValueError(f"no aggregate {agg!r} over streams; there are {', '.join(BOUNDED)}")
    c = columns or detect(df)
    rows = df.select(as_timestamp(df, c.time).alias("__ts"), F.col(c.lat).alias("lat"), F.col(c.lon).alias("lon"), F.col(c.value).alias("__v")).withWatermark("__ts", lateness)
    window = F.window("__ts", WINDOWS[freq], WINDOWS[freq], OFFSETS.get(freq, "0 seconds"))
    out = rows.groupBy(window.alias("w"), "lat", "lon").agg(AGGREGATES[agg](F.col("__v")).alias("value"))
    return out.select(F.col("w.start").alias("time"), "lat", "lon", "value")
