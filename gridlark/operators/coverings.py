"""Coverings of a column of geometries (their bounding boxes): one row per cell.

The boxes are parsed by Spark expressions, different boxes searched by rounds of Spark steps (``descent``), and their
cells joined to the rows.  Streams and the SQL names, where no rounds of jobs can run, search a batch of boxes in an Arrow
UDF, with the same outcome.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells, wkt
from . import rectcover
from .cells import children
from .descent import BOX as _BOX
from .descent import rects as _rects
from .descent import searched

# --- fixed values ---------------------------------------------------------------
COVERING_CELLS = 64
LEAST_INTERIOR_CELLS = 4
# ----------------------------------------------------------------------------------
# No box has more than rectcover.FORCED_LIMIT cells at levels below this.
_EASY_LEVEL = 5


# Cells that a search holds at a time, about; boxes beyond it wait for the next search.
_HELD_CELLS = 100_000


def _parts(rects: rectcover.Rects, lo: np.ndarray, limit: np.ndarray) -> list[np.ndarray]:
    """Boxes dealt to searches by the number of cells they are bound to hold."""
    side = np.pi / 2 / 2.0 ** np.clip(lo, 0, 30)
    wide = 2 * rects.half * np.cos(np.minimum(np.abs(rects.lat_lo), np.abs(rects.lat_hi)))
    forced = (wide / side + 2) * ((rects.lat_hi - rects.lat_lo) / side + 2)
    held = 16 + 4 * limit + np.minimum(np.where(np.isfinite(forced), forced, 0), 4 * rectcover.FORCED_LIMIT)
    return np.split(np.arange(len(lo)), np.flatnonzero(np.diff(np.cumsum(held) // _HELD_CELLS)) + 1)


def _cover_batch(box: pa.StructArray, lo: pa.Array, hi: pa.Array, limit: pa.Array, interior: bool):
    rects = _rects(box)
    levels = [a.to_numpy(zero_copy_only=False) for a in (lo, hi, limit)]
    owners, found = [], []
    for part in _parts(rects, levels[0], levels[2]):
        owner, ids = rectcover.cover(rects.take(part), *(x[part] for x in levels), interior)
        owners.append(part[owner])
        found.append(ids)
    ends = np.cumsum(np.bincount(np.concatenate(owners), minlength=len(box))) if len(box) else []
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(np.concatenate(found), pa.int64()))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _covering_cells(box: pa.Array, lo: pa.Array, hi: pa.Array, limit: pa.Array) -> pa.Array:
    return _cover_batch(box, lo, hi, limit, interior=False)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _interior_cells(box: pa.Array, lo: pa.Array, hi: pa.Array, limit: pa.Array) -> pa.Array:
    return _cover_batch(box, lo, hi, limit, interior=True)


@F.arrow_udf(T.BooleanType())
def _box_meets_cell(box: pa.Array, face: pa.Array, i: pa.Array, j: pa.Array, level: pa.Array) -> pa.Array:
    rects = _rects(box)
    face, i, j, level = (a.to_numpy(zero_copy_only=False) for a in (face, i, j, level))
    meets = np.zeros(len(face), bool)
    for lv in np.unique(level):
        at = np.flatnonzero(level == lv)
        squares = rectcover.Cells(face[at], i[at], j[at], int(lv))
        meets[at] = rectcover.relate(rects.take(at), squares)[0]
    return pa.array(meets)


_square = cells.Formula(
    "square", {"cell": "bigint"}, "struct<f:bigint,i:bigint,j:bigint>",
    "named_struct('f', {f}, 'i', {i}, 'j', {j})", cells.decode_steps(),
)


def _boxed(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_box", F.expr(wkt.bounds(f"`{text}`"))).where("_box IS NOT NULL")


def _generate(df: DataFrame, udf, text: str, lo: int, hi: int, limit: int, out: str) -> DataFrame:
    """Rows of a stream with the cells of their boxes."""
    keep = [c for c in df.columns if c != out]
    arrays = _boxed(df, text).withColumn("_ids", udf("_box", F.lit(lo), F.lit(hi), F.lit(limit)))
    return arrays.select(*keep, "_box", F.explode("_ids").alias(out))


def _joined(df: DataFrame, text: str, lo: int, hi: int, limit: int, interior: bool, out: str) -> DataFrame:
    boxed = _boxed(df, text)
    found = searched(boxed, lo, hi, limit, interior).withColumnsRenamed({"_box": "_of", "cell": "_cell"})
    keep = [f"`{c}`" for c in df.columns if c != out]
    return boxed.join(found, F.expr("_box = _of")).selectExpr(*keep, f"_cell AS `{out}`")


def covering(df: DataFrame, text: str, min_level: int, max_level: int, out: str = "cell_id") -> DataFrame:
    """One row per cell of a covering of the bounding box of the WKT in column ``text``.

    At most 64 cells per geometry unless ``min_level`` needs more.  Text that is
    no geometry gives no rows.
    """
    lo = min(max(min_level, 0), 30)
    keep = [c for c in df.columns if c != out]
    if not df.isStreaming:
        return _joined(df, text, lo, max_level, COVERING_CELLS, False, out)
    found = _generate(df, _covering_cells, text, lo, max_level, COVERING_CELLS, out)
    if lo == 0:
        return found.select(*keep, out)
    # coarser cells (merged siblings, or huge boxes left unfinished) down to the minimum level
    own = cells.level_of(f"`{out}`")
    found = found.selectExpr("*", f"greatest({lo}, {own}) AS _level", f"{own} < {lo} AS _coarse")
    found = children(found, out, "_level", "_cell").drop(out).withColumnRenamed("_cell", out)
    if lo > _EASY_LEVEL:
        squared = _square.add(found, "_q", out)
        meets = _box_meets_cell("_box", "_q.f", "_q.i", "_q.j", "_level")
        found = squared.withColumn("_meets", meets).where("_meets OR NOT _coarse")
    return found.select(*keep, out)


def interior_covering(
    df: DataFrame, text: str, min_level: int, max_level: int, max_cells: int, out: str = "cell_id"
) -> DataFrame:
    """One row per cell wholly inside the bounding box, at most ``max_cells`` (4 or more) per geometry."""
    lo = min(max(min_level, 0), 30)
    keep = [c for c in df.columns if c != out]
    limit = max(max_cells, LEAST_INTERIOR_CELLS)
    if not df.isStreaming:
        return _joined(df, text, lo, max_level, limit, True, out)
    found = _generate(df, _interior_cells, text, lo, max_level, limit, out)
    if lo == 0:
        return found.select(*keep, out)
    found = found.selectExpr("*", f"greatest({lo}, {cells.level_of(f'`{out}`')}) AS _level")
    return children(found, out, "_level", "_cell").select(*keep, F.col("_cell").alias(out))
