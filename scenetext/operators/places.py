"""Points on a map: lookup of coordinates by code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetext.plans.sizing import BROADCAST_BYTES, measured_bytes


def load_places(df: DataFrame, coordinate: str = "coord") -> DataFrame:
    """``code, lon, lat`` from a coordinate array; rows without exactly two numbers are rejected.
    A repeated code is one place, the one of its points that comes first by lon, then lat."""
    point = F.col(coordinate)
    valid = df.where(F.size(coordinate) == 2)
    first = F.min(F.struct(point[0].alias("lon"), point[1].alias("lat"))).alias("p")
    return valid.groupBy("code").agg(first).select("code", "p.lon", "p.lat")


def place_points(
    points: DataFrame, places: DataFrame, on: str = "code", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Coordinates and a label for every point (``code, value``) whose key has a place.

    ``places`` has one row per ``on``. It is broadcast if it measures up to
    ``limit`` bytes; a larger one is joined by shuffle, and adaptive execution
    splits the partitions of hot keys.
    """
    small = measured_bytes(places)[0] <= limit
    joined = points.join(F.broadcast(places) if small else places, on, "inner")
    return joined.select(
        "code", "lon", "lat", "value", F.concat_ws(" : ", "code", "value").alias("label")
    )
