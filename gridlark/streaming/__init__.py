"""The functions on streams.

Cell functions keep no state, so ``formula.add`` works on a streaming DataFrame
as it stands.  Counting per cell is the one stateful use: state is bounded by
the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells


def windowed_density(
    points: DataFrame, lat: str, lon: str, level: int, time: str, window: str, late: str
) -> DataFrame:
    """Points per cell and time window: columns ``start, end, cell_id, n``.

    ``late`` is how long a window stays open for late rows.
    """
    cell = cells.s2_cell_id.add(points.withWatermark(time, late), "cell_id", lat, lon, level)
    counted = cell.where("cell_id IS NOT NULL").groupBy(F.window(time, window).alias("w"), "cell_id")
    return counted.agg(F.count("*").alias("n")).select("w.start", "w.end", "cell_id", "n")
