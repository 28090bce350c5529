"""The search for cells over boxes, as steps of Spark.

A table of (box, cell) goes down from the six faces: each round takes the four children of every open cell, asks a small
UDF which of them meet the box and which lie inside, and picks by a window per box what the budget lets grow.  Only
different boxes are searched.  Python sees a box and a few cells, never a search.

Boxes with more cells at the minimum level than the budget need no window: there a cell grows only while one child meets
the box, whatever the others do, so each of their cells is a group of its own and no group grows with the level.
Interior searches look at a box's cells of one level together; what they keep inside is bounded by the budget, the
boundary by the cells along the box's outline.

Null boxes have no cells; an empty table gives an empty one; repeated boxes are searched once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells, vectorized
from ..functions.fixed import MAX_LEVEL
from ..session import stored
from . import rectcover

BOX = ("lat_lo", "lat_hi", "lon_lo", "lon_hi")
_FACES = ", ".join(f"{((f << 61 | 1 << 60) + (1 << 63)) % (1 << 64) - (1 << 63)}L" for f in range(6))
# Rounds planned as one job: each holds a Python worker per task.
ROUNDS = 4
# Cells that a task gets, about.
_TASK_CELLS = 100_000
_SHIFT = 8


def rects(box: pa.StructArray) -> rectcover.Rects:
    return rectcover.Rects.of_degrees(*(box.field(n).to_numpy(zero_copy_only=False) for n in BOX))


@F.arrow_udf(T.IntegerType())
def box_against(box: pa.Array, ids: pa.Array) -> pa.Array:
    """Bit k: the k-th cell (of 8 at most) meets the box; bit 8 + k: it lies inside."""
    n = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    own, out = rects(box), np.zeros(len(n), np.int32)
    bits = flat & -flat
    f, i, j, _ = vectorized._square(flat)
    for bit in np.unique(bits):
        at = np.flatnonzero(bits == bit)
        level = MAX_LEVEL - (int(bit).bit_length() - 1) // 2
        meets, inside = rectcover.relate(own.take(owner[at]), rectcover.Cells(f[at], i[at], j[at], level))
        np.add.at(out, owner[at], (meets + (inside.astype(np.int32) << _SHIFT)) << place[at])
    return pa.array(out)


def _grown(state: DataFrame, ids: list[str], alive: str, done: str, grow: str = "NOT done") -> DataFrame:
    """Rows that ``grow`` give their living cells of ``ids``; the others stay, and are done."""

    def row(cell: str, ended: str, inside: str) -> str:
        return f"named_struct('cell', {cell}, 'done', {ended}, 'inside', {inside})"

    kids = (
        f"if(getbit({alive}, {k}) = 1, {row(c, f'getbit({done}, {k}) = 1', f'getbit(_r, {_SHIFT + k}) = 1')}, NULL)"
        for k, c in enumerate(ids)
    )
    each = f"if({grow}, array_compact(array({', '.join(kids)})), array({row('cell', 'true', 'inside')}))"
    return state.selectExpr("_g", "_box", "_key", f"inline({each})")


def _judged(level: int, lo: int, hi: int, interior: bool) -> tuple[str, str]:
    """Bits of the cells of ``level`` that live on, and of those that are done, from ``_r``."""
    inside = f"(shiftright(_r, {_SHIFT}) & 255)"
    ready, last = lo <= level, hi <= level
    if interior:
        return (f"(_r & {inside})" if ready and last else "(_r & 255)"), (inside if ready else "0")
    return "(_r & 255)", ("255" if ready and last else inside if ready else "0")


def _kept(state: DataFrame, limit: int) -> DataFrame:
    """Interior: the first cells inside, by level and place, up to the budget; the outline only below the budget."""
    window = f"(PARTITION BY _g ORDER BY NOT inside, {cells.lsb('cell')} DESC, cell < 0, cell ROWS BETWEEN UNBOUNDED PRECEDING AND {{}})"
    ranked = state.selectExpr(
        "*", f"row_number() OVER {window.format('CURRENT ROW')} AS _n",
        f"count_if(inside) OVER {window.format('UNBOUNDED FOLLOWING')} AS _in",
    )
    return ranked.where(f"if(inside, _n <= {limit}, _in < {limit})").drop("_n", "_in")


def _round(state: DataFrame, level: int, lo: int, hi: int, limit: int, interior: bool, tasks: int) -> DataFrame:
    """Cells of ``level`` that are open give way to their children, or are done.

    Spark doesn't know rows to be still where they were after a Python function, so a window's rows are dealt before it:
    to a number of tasks that is given, as few small rows are much work here.
    """
    if interior:
        state = _kept(state.repartition(tasks, "_g"), limit)
    quarter = 1 << 2 * (MAX_LEVEL - level - 1)
    ids = [f"(cell + ({(2 * k - 3) * quarter}L))" for k in range(4)]
    state = state.withColumn("_ids", F.expr(f"if(done, NULL, array({', '.join(ids)}))"))
    state = state.withColumn("_r", box_against("_box", "_ids")).drop("_ids")
    alive, done = _judged(level + 1, lo, hi, interior)
    if interior or level < lo:
        return _grown(state, ids, alive, done)
    state = state.repartition(tasks, "_g", "_key").selectExpr("*", f"bit_count({alive}) AS _alive", f"bit_count({alive} & {done}) AS _ended")
    state = state.where("done OR _alive > 0").selectExpr("*", "NOT done AND _ended < 4 AS _open")
    # cells with fewer living children first, then with fewer done ones, as long as the budget allows
    window = "(PARTITION BY _g, _key ORDER BY _alive, _ended, cell < 0, cell ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
    more = f"sum(if(_open, _alive - 1, 0)) OVER {window.format('CURRENT ROW')}"
    state = state.selectExpr("*", f"{more} + count(*) OVER {window.format('UNBOUNDED FOLLOWING')} AS _total")
    return _grown(state, ids, alive, done, f"_open AND (_alive = 1 OR (_key = 0 AND _total <= {limit}))")


def _merged(found: DataFrame, lo: int) -> DataFrame:
    """Four siblings as their parent, no cell above level ``lo``: the highest ancestors whose leaves are all there."""
    own = cells.level_of("cell")
    above = found.selectExpr("_g", "_box", "cell", f"explode(sequence(least({lo}, {own}), {own})) AS _level")
    above = above.selectExpr("_g", "_box", f"{cells.ancestor('cell', '_level')} AS cell", f"{cells.lsb('cell')} AS _leaves")
    full = above.groupBy("_g", "cell").agg(F.first("_box").alias("_box"), F.sum("_leaves").alias("_leaves"))
    full = full.where(f"_leaves = {cells.lsb('cell')}")
    parent = f"if({own} > {lo}, {cells.ancestor('cell', f'({own} - 1)')}, NULL)"
    child = full.selectExpr("_g", "_box", "cell", f"{parent} AS _parent")
    inner = full.selectExpr("_g", "cell AS _parent")
    return child.join(inner, ["_g", "_parent"], "left_anti").select("_box", "cell")


def _stored(state: DataFrame) -> tuple[DataFrame, int]:
    """The state, written, and how many of its cells are open: counted while they are written."""
    seen = Observation()
    state = stored(state.observe(seen, F.count_if(~F.col("done")).alias("open")))
    return state, seen.get["open"]


def searched(boxes: DataFrame, lo: int, hi: int, limit: int, interior: bool) -> DataFrame:
    """(_box, cell) rows of a covering of each different ``_box``, or of cells wholly inside.

    ``limit`` cells at most, but all those at level ``lo`` that meet the box; levels ``lo`` to ``hi``.  Tables between
    rounds are written to the shared folder.
    """
    lo, last = min(max(lo, 0), MAX_LEVEL), min(max(hi, lo, 0), MAX_LEVEL)
    cores = boxes.sparkSession.sparkContext.defaultParallelism
    different = boxes.where("_box IS NOT NULL").select("_box").distinct()
    state, rows = _stored(
        different.selectExpr(
            "monotonically_increasing_id() AS _g", "_box", "0L AS _key", "0L AS cell", "false AS done", "false AS inside"
        )
    )
    level = -1
    while rows and level < last:
        tasks = max(cores, rows // _TASK_CELLS)
        if level < 0:
            state = state.repartition(tasks, "_g", "_key").withColumn("_r", box_against("_box", F.expr(f"array({_FACES})")))
            state = _grown(state, _FACES.split(", "), *_judged(0, lo, hi, interior))
            level = 0
        elif not interior:
            state = state.repartition(tasks, "_g", "cell")
        stop = min(level + ROUNDS, last, lo if level < lo and not interior else last)
        for level in range(level, stop):
            state = _round(state, level, lo, hi, limit, interior, tasks)
        level = stop
        state, rows = _stored(state)
        if rows and level == lo and not interior:
            many = state.groupBy("_g").agg(F.count("*").alias("_n")).where(f"_n > {limit}")
            state = state.join(many, "_g", "left").selectExpr(
                "_g", "_box", "if(_n IS NULL, 0L, cell) AS _key", "cell", "done", "inside"
            )
    if interior:
        state = _kept(state.where("done"), limit)
    found = state.where("done").select("_g", "_box", "_key", "cell")
    if lo == last:
        return found.select("_box", "cell")
    # cells that grew one by one have no siblings
    return found.where("_key <> 0").select("_box", "cell").unionByName(_merged(found.where("_key = 0"), lo))
