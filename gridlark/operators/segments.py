"""Unions of cells as rows: segments with a directory, look-ups in them, and the normal form.

A segment is what a group has below one fixed ancestor: at ``LEVEL`` for cells at that level or below, and the face for
wider cells.  The key depends on the cell alone, so a group of any size is spread over its segments, and no step gathers a
group.  Inside a segment cells that lie in another are left out, so its ids are disjoint and sorted, and one binary search
answers whether it holds a cell; a cell is looked up in two segments, its own and its face's.

Null cells and ids that are no cells are left out, copies count once.  Groups may be null and then are one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import cells
from ..session import stored

LEVEL = 12
_FOUR = 4


def _keys(by: list[str]) -> list:
    return [F.col(f"`{k}`") for k in by]


def _same(by: list[str], left: str, right: str) -> str:
    return " AND ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in by) or "true"


def outer_cells(df: DataFrame, by: list[str], cell: str, level: int = LEVEL) -> DataFrame:
    """(by, segment, cell): the different cells of each group, without those inside another cell of their segment."""
    is_cell = f"{cells.lsb('cell')} & 6148914691236517205L <> 0 AND shiftrightunsigned(cell, 61) < 6 AND cell <> -9223372036854775807L - 1L"
    rows = df.select(*_keys(by), F.col(f"`{cell}`").alias("cell")).where(f"cell IS NOT NULL AND {is_cell}").distinct()
    own = cells.level_of("cell")
    rows = rows.selectExpr("*", f"if({own} < {level}, {cells.ancestor('cell', '0')}, {cells.ancestor('cell', str(level))}) AS segment",
                           f"{own} < {level} AS _wide", f"{cells.range_min('cell')} AS _lo", f"{cells.range_max('cell')} AS _hi")
    # cells are nested or apart: one lies in an earlier one if that reaches as far
    before = Window.partitionBy(*_keys(by), "_wide", "segment").orderBy("_lo", F.desc("_hi")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_reach", F.max("_hi").over(before)).where("_reach IS NULL OR _reach < _lo")
    return rows.select(*_keys(by), "_wide", "segment", "cell")


def cell_union_segments(df: DataFrame, by: list[str], cell: str, level: int = LEVEL) -> DataFrame:
    """(by, wide, segment, first, last, n, ids): the segments of each group's union, with their first and last id.

    ``wide``: of cells above ``level``, by face; else by ancestor at ``level``.
    """
    rows = outer_cells(df, by, cell, level).groupBy(*_keys(by), F.col("_wide").alias("wide"), "segment")
    return rows.agg(
        F.min("cell").alias("first"), F.max("cell").alias("last"), F.count("*").alias("n"), F.array_sort(F.collect_list("cell")).alias("ids")
    )  # as many ids as the segment has


def _at_or_before(ids: str, value: str) -> str:
    """Place (from 1) of the last id whose range starts at ``value`` or before; 0 if none.  Halves the array 31 times at most."""
    mid = "CAST((s.lo + s.hi + 1) DIV 2 AS INT)"
    start = cells.range_min(f"element_at({ids}, {mid})")
    turn = f"if(s.lo = s.hi, s, if({start} <= {value}, named_struct('lo', {mid}, 'hi', s.hi), named_struct('lo', s.lo, 'hi', {mid} - 1)))"
    return f"aggregate(sequence(1, 32), named_struct('lo', 0, 'hi', size({ids})), (s, k) -> {turn}, s -> s.lo)"


def segments_contain(segments: DataFrame, requests: DataFrame, by: list[str], cell: str, out: str = "held", level: int = LEVEL) -> DataFrame:
    """``requests`` with whether their group's union holds their cell; false for groups that aren't there, null for null cells."""
    own = cells.level_of(f"`{cell}`")
    found = requests.selectExpr("*", f"if({own} < {level}, NULL, {cells.ancestor(f'`{cell}`', str(level))}) AS _near",
                                f"{cells.ancestor(f'`{cell}`', '0')} AS _face")
    held = []
    for side, key, wide in (("_s0", "_near", "NOT wide"), ("_s1", "_face", "wide")):
        # the directory bounds the search: beyond first and last nothing is looked for
        part = segments.where(wide).select(*(F.col(f"`{k}`").alias(f"{side}_{i}") for i, k in enumerate(by)), F.col("segment").alias(side), F.col("ids").alias(f"{side}_ids"),
                                           F.col("first").alias(f"{side}_first"), F.col("last").alias(f"{side}_last"))
        match = F.expr(" AND ".join([f"{key} = {side}", *(f"`{k}` <=> {side}_{i}" for i, k in enumerate(by))]))
        found = found.join(part, match, "left")
        ids, at = f"{side}_ids", _at_or_before(f"{side}_ids", f"`{cell}`")
        inside = f"`{cell}` BETWEEN {cells.range_min(f'{side}_first')} AND {cells.range_max(f'{side}_last')}"
        reach = cells.range_max(f"element_at({ids}, greatest(place, 1))")
        search = f"exists(array({at}), place -> place > 0 AND {reach} >= `{cell}`)"
        held.append(f"coalesce({ids} IS NOT NULL AND {inside} AND {search}, false)")
    return found.selectExpr(*(f"`{c}`" for c in requests.columns if c != out), f"if(`{cell}` IS NULL, NULL, {held[0]} OR {held[1]}) AS `{out}`")


def normalized(df: DataFrame, by: list[str], cell: str, level: int = LEVEL) -> DataFrame:
    """(by, cell): each group's union in normal form: no cell in another, four siblings as their parent.

    From the finest level up, one round a level: cells meet their siblings by their parent, four of them become it and go
    on to the next round.  Rounds are cut off from their past by tables in the shared folder.
    """
    rows = stored(outer_cells(df, by, cell, level))
    # segments that lie in a wide cell of their group
    fine = rows.where("NOT _wide").select(*_keys(by), "segment").distinct()
    above = ", ".join(cells.ancestor("segment", str(k)) for k in range(level))
    wide = rows.where("_wide").select(*_keys(by), "cell")
    if level:
        up = fine.select("*", F.explode(F.expr(f"array({above})")).alias("_up")).alias("a")
        covered = up.join(wide.alias("b"), F.expr(f"a._up = b.cell AND {_same(by, 'a', 'b')}"), "left_semi").select(*_keys(by), "segment").distinct()
        same = F.expr(f"NOT a._wide AND a.segment = b.segment AND {_same(by, 'a', 'b')}")
        rows = rows.alias("a").join(covered.alias("b"), same, "left_anti")
    rows = stored(rows.selectExpr(*(f"`{k}`" for k in by), "cell", f"{cells.level_of('cell')} AS _level"))
    present = sorted((r["_level"] for r in rows.select("_level").distinct().collect()), reverse=True)  # 31 at most
    done, merged, at = None, None, present[0] if present else 0
    while at > 0 and (merged is not None or any(k <= at for k in present)):
        here = rows.where(F.col("_level") == at).select(*_keys(by), "cell")
        here = here if merged is None else here.unionAll(merged)
        met = here.groupBy(*_keys(by), F.expr(cells.ancestor("cell", str(at - 1))).alias("_up")).agg(F.collect_list("cell").alias("_cells"))  # 4 at most
        met = stored(met)
        alone = met.where(f"size(_cells) < {_FOUR}").select(*_keys(by), F.explode("_cells").alias("cell"))
        merged = met.where(f"size(_cells) = {_FOUR}").select(*_keys(by), F.col("_up").alias("cell"))
        done, at = alone if done is None else done.unionAll(alone), at - 1
        if merged.isEmpty():
            merged, at = None, max((k for k in present if k <= at), default=0)
    faces = rows.where("_level = 0").select(*_keys(by), "cell")
    parts = [x for x in (done, merged, faces) if x is not None]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.withColumnRenamed("cell", cell)
