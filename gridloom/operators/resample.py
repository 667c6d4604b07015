"""Resampling in time, and finding out which columns are which."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FREQUENCIES = ("hour", "day", "week", "month", "year")
AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "median": F.median,
    # Ties go to the smallest value.
    "mode": lambda c: F.mode(c, deterministic=True),
    "stddev": F.stddev_samp,
    "variance": F.var_samp,
}


@dataclass
class Columns:
    time: str
    lat: str
    lon: str
    value: str
    numeric_time: bool


def detect(df: DataFrame) -> Columns:
    """Time, latitude, longitude and value; exact names win over names that contain them."""
    lower = {c: c.lower() for c in df.columns}

    def find(exact: tuple[str, ...], parts: tuple[str, ...]) -> str | None:
        by_name = next((c for e in exact for c in df.columns if lower[c] == e), None)
        return by_name or next((c for c in df.columns if any(p in lower[c] for p in parts)), None)

    time = find(("time", "date", "datetime", "t"), ("time", "date"))
    lat = find(("lat", "latitude", "y"), ("lat",))
    lon = find(("lon", "longitude", "x"), ("lon",))
    if time is None or lat is None or lon is None:
        raise ValueError(f"can't tell time, latitude and longitude among {', '.join(df.columns)}")
    value = next((c for c in df.columns if c not in (time, lat, lon) and lower[c] != "geom"), None)
    if value is None:
        raise ValueError("there is no value column")
    return Columns(time, lat, lon, value, isinstance(df.schema[time].dataType, T.NumericType))


def value_column(df: DataFrame) -> str:
    """The first column that is no coordinate."""
    for c in df.columns:
        name = c.lower()
        if name not in ("x", "y", "t", "geom") and not any(p in name for p in ("time", "date", "lat", "lon")):
            return c
    raise ValueError("there is no value column")


def as_timestamp(df: DataFrame, column: str) -> Column:
    """Numbers are seconds since 1970, in UTC."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.timestamp_seconds(F.col(column).cast("long"))
    return F.to_timestamp(column) if isinstance(kind, T.StringType) else F.col(column)


def resample(df: DataFrame, freq: str, agg: str, columns: Columns | None = None) -> DataFrame:
    """time (truncated), lat, lon, value: one partial aggregation and one shuffle."""
    freq, agg = freq.lower(), agg.lower()
    if freq not in FREQUENCIES:
        raise ValueError(f"no frequency {freq!r}; there are {', '.join(FREQUENCIES)}")
    if agg not in AGGREGATES:
        raise ValueError(f"no aggregate {agg!r}; there are {', '.join(AGGREGATES)}")
    c = columns or detect(df)
    at = F.date_trunc(freq, as_timestamp(df, c.time))
    return df.groupBy(at.alias("time"), F.col(c.lat).alias("lat"), F.col(c.lon).alias("lon")).agg(AGGREGATES[agg](F.col(c.value)).alias("value"))
