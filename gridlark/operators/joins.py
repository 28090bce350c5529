"""Spatial joins as equi-joins on cells: no nested loops, no cross joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells, wkt
from ..session import stored
from . import sweep
from .cells import neighbors
from .coverings import covering


def levels_of(df: DataFrame, cell: str) -> list[int]:
    """The distinct levels in a column of cells (31 at most)."""
    rows = df.selectExpr(f"{cells.level_of(f'`{cell}`')} AS level").where(f"`{cell}` IS NOT NULL").distinct().collect()
    return sorted(r.level for r in rows)


def _ancestors(df: DataFrame, cell: str, levels: list[int], out: str, only: str = "true") -> DataFrame:
    """One row per ancestor of ``cell`` at the given levels (its own level included)."""
    if not levels:
        return df.where("false").selectExpr("*", f"CAST(NULL AS BIGINT) AS `{out}`")
    list_ = ", ".join(map(str, levels))
    df = df.selectExpr("*", f"explode(array({list_})) AS _level").where(only)
    return df.selectExpr("*", f"{cells.ancestor(f'`{cell}`', '_level')} AS `{out}`").drop("_level")


def points_in_cells(
    points: DataFrame, table: DataFrame, lat: str, lon: str, cell: str = "cell_id"
) -> DataFrame:
    """Points with every row of ``table`` whose cell holds them (one row per pair).

    A point moves once to find its cells (``sweep``), and then to their rows.  ``table`` is read twice: store it first if
    it is costly.
    """
    leaf, some = (cells.s2_cell_id.add(p, "_leaf", lat, lon, 30) for p in (points, points.sample(sweep.SAMPLED, seed=1)))
    keyed = sweep.holding_cells(leaf, "_leaf", some.select("_leaf"), table, cell, cell)
    return keyed.join(table, [cell])


def points_in_fences(
    points: DataFrame,
    fences: DataFrame,
    fence: str,
    text: str,
    lat: str,
    lon: str,
    min_level: int = 0,
    max_level: int = 30,
) -> DataFrame:
    """Points with the key of every fence whose bounding box holds them.

    The covering finds the candidates; the box itself decides, so coarse cells add no pairs.
    """
    covered = covering(fences.select(fence, text), text, min_level, max_level)
    boxed = covered.withColumn("_box", F.expr(wkt.bounds(f"`{text}`"))).select(fence, "cell_id", "_box.*")
    # looked at twice below: sweep, join
    boxed = stored(boxed)
    pairs = points_in_cells(points, boxed, lat, lon)
    inside = f"`{lat}` BETWEEN lat_lo AND lat_hi AND `{lon}` BETWEEN lon_lo AND lon_hi"
    return pairs.where(inside).select(*points.columns, fence)


def neighbor_join(
    left: DataFrame, right: DataFrame, cell: str, right_cell: str, how: str = "inner"
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` in an edge-adjacent cell of the same level.

    ``how="left_semi"`` keeps left rows that have any such neighbour.
    """
    around = neighbors(left, cell, right_cell)
    if how == "left_semi":
        found = around.join(right.select(right_cell).distinct(), [right_cell], how)
        return found.drop(right_cell).distinct()
    return around.join(right, [right_cell], how)


def union_overlap_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, cell: str = "cell_id"
) -> DataFrame:
    """Pairs of keys whose cell sets overlap.

    Two cells overlap only if one is an ancestor of the other or the same.  Each side is listed by its own cells and by
    their ancestors at the other side's levels; own cells meet the other side's ancestors in a single join.
    """
    # looked at twice below: levels, ancestors
    left, right = (
        stored(side.select(key, cell).where(f"`{cell}` IS NOT NULL").distinct())
        for side, key in ((left, left_key), (right, right_key))
    )
    own = cells.level_of(f"`{cell}`")

    def listed(side: DataFrame, key: str, levels: list[int], only: str, up: int) -> DataFrame:
        above = _ancestors(side, cell, levels, "_up", only).select(key, F.lit(up).alias("_kind"), F.col("_up").alias(cell))
        return above.distinct().unionAll(side.select(key, F.lit(1 - up).alias("_kind"), cell))

    lefts = listed(left, left_key, levels_of(right, cell), f"_level <= {own}", 1)
    rights = listed(right, right_key, levels_of(left, cell), f"_level < {own}", 0)
    return lefts.join(rights, [cell, "_kind"]).select(left_key, right_key).distinct()


def cell_density(points: DataFrame, lat: str, lon: str, levels: int | list[int]) -> DataFrame:
    """Points per cell: columns ``level, cell_id, n``; coarser levels are rolled up from counts."""
    wanted = [levels] if isinstance(levels, int) else sorted(set(levels))
    cell = cells.s2_cell_id.add(points.select(lat, lon), "cell_id", lat, lon, max(wanted))
    counted = cell.where("cell_id IS NOT NULL").groupBy("cell_id").agg(F.count("*").alias("n"))
    if len(wanted) == 1:
        return counted.select(F.lit(wanted[0]).alias("level"), "cell_id", "n")
    at = ", ".join(map(str, wanted))
    rolled = counted.selectExpr("cell_id", "n", f"explode(array({at})) AS level")
    rolled = rolled.selectExpr("level", f"{cells.ancestor('cell_id', 'level')} AS cell_id", "n")
    return rolled.groupBy("level", "cell_id").agg(F.sum("n").alias("n"))
