"""Row generators over a column of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import cells

_STRIDE = 6  # levels generated per explode: arrays of at most 4^6 ids


def children(df: DataFrame, cell: str, level: int | str, out: str = "child_id", deep: int = 30) -> DataFrame:
    """One row per descendant of ``cell`` at ``level``, in cell order; none if that is coarser.

    Works down a few levels at a time, so no array grows with the depth.  ``deep``: no cell is further above ``level``.
    """
    turns = -(-min(deep, level if isinstance(level, int) else 30) // _STRIDE)
    keep = [f"`{c}`" for c in df.columns if c != out]
    target = f"{level}" if isinstance(level, int) else f"`{level}`"
    own = cells.level_of("_c")
    df = df.selectExpr(*keep, f"CAST({target} AS INT) AS _to", f"`{cell}` AS _c").where(
        f"_to BETWEEN {own} AND 30"
    )
    for _ in range(max(turns, 1)):
        df = df.selectExpr(
            *keep, "_to", "_c", f"{cells.lsb('_c')} AS _b",
            f"{cells.level_lsb(f'least(_to, {own} + {_STRIDE})')} AS _n",
        ).selectExpr(*keep, "_to", "explode(sequence(_c - (_b - _n), _c + (_b - _n), 2 * _n)) AS _c")
    return df.selectExpr(*keep, f"_c AS `{out}`")


def neighbors(df: DataFrame, cell: str, out: str = "neighbor_id") -> DataFrame:
    """Four rows per cell: the edge neighbours at the same level (down, right, up, left)."""
    df = df.where(f"`{cell}` IS NOT NULL").selectExpr("*", "explode(array(0, 1, 2, 3)) AS _k")
    return cells.s2_edge_neighbor.add(df, out, cell, "_k").drop("_k")
