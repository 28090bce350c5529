"""Which cells of a table hold which positions, by one sweep along the curve.

A cell is an interval of leaf ids, and two cells are nested or apart, so along the curve at most 31 different cells are
open at a time.  Positions and cells are dealt to tasks by the same bounds (quantiles of a sample of positions; a cell
goes to each range that it reaches into), sorted by leaf, and merged once with the open cells as a stack.  A position
moves once, whatever the levels, and leaves the sweep once for each cell that holds it.

A place so frequent that it fills several ranges is a bound several times; its positions are spread over these ranges by a
hash of their rows, and the cells around it go to all of them.  Cells that many rows of a table share are one here: they
meet those rows in the join that follows, where Spark splits frequent keys of either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells

# Share of the positions from which the bounds are taken; it decides how even the ranges are, never what is found.
SAMPLED = 0.02
_ATOMIC = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DatetimeType)


def bounds_of(sample: DataFrame, leaf: str, ranges: int) -> list[int]:
    """Quantiles that cut the sampled positions into so many ranges; none for an empty sample."""
    shares = F.lit([k / ranges for k in range(1, ranges)]).cast("array<double>")
    if ranges < 2:
        return []
    row = sample.where(f"`{leaf}` IS NOT NULL").agg(F.percentile_approx(leaf, shares, 10_000).alias("b")).first()
    return sorted(row.b or [])


def _range_of(bounds: list[int]):
    """The first and last range that a leaf may be in."""
    cuts = np.array(bounds, np.int64)

    @F.arrow_udf("first int, last int")
    def run(leaf: pa.Array) -> pa.Array:
        leaf = leaf.to_numpy(zero_copy_only=False)
        ends = [pa.array(np.searchsorted(cuts, leaf, side), pa.int32()) for side in ("left", "right")]
        return pa.StructArray.from_arrays(ends, ["first", "last"])

    return run


def _hash(df: DataFrame) -> Column:
    return F.xxhash64(*(df[f"`{f.name}`"] for f in df.schema.fields if isinstance(f.dataType, _ATOMIC)))


def _merge(width: int):
    """Sorted rows (range, leaf, last leaf of a cell or null, cell, the position's columns) -> the columns with each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last, cell, parent = -1, [], [], []  # of the open cells, outermost first
        for batch in batches:
            range_, leaf = (batch.column(k).to_numpy() for k in (0, 1))
            start = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            lasts = batch.column(2).fill_null(0).to_numpy()
            ids = batch.column(3).fill_null(0).to_numpy()
            # the stack after each start: a new cell's parent is the innermost one that is still open there
            last, cell, top = list(last), list(cell), len(last) - 1
            before = top
            tops = np.full(len(leaf), -2, np.int64)
            for k in np.flatnonzero(start | np.r_[range_[:1] != current, range_[1:] != range_[:-1]]).tolist():
                if range_[k] != current:
                    current, top = range_[k], -1
                    tops[k] = -1
                if start[k]:
                    while top >= 0 and last[top] < leaf[k]:
                        top = parent[top]
                    last.append(int(lasts[k]))
                    cell.append(int(ids[k]))
                    parent.append(top)
                    top = tops[k] = len(last) - 1
            known = np.flatnonzero(tops != -2)
            at = np.searchsorted(known, np.arange(len(leaf)), "right") - 1
            open_ = np.where(at >= 0, tops[known[at]] if len(known) else -1, before)
            point = np.flatnonzero(~start)
            open_ = open_[point]
            ends, numbers, above = (np.array(x, np.int64) for x in (last, cell, parent))
            found, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            while len(point := point[open_ >= 0]):
                open_ = open_[open_ >= 0]
                inside = ends[open_] >= leaf[point]
                found.append(point[inside])
                held.append(numbers[open_[inside]])
                open_ = above[open_]
            rows, numbers = np.concatenate(found), np.concatenate(held)
            taken = batch.select(range(4, 4 + width)).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(numbers)], [*taken.schema.names, "_held"])
            # only what is open at the end goes on
            chain = []
            while top >= 0:
                chain.append(top)
                top = parent[top]
            chain.reverse()
            last, cell, parent = [last[k] for k in chain], [cell[k] for k in chain], list(range(-1, len(chain) - 1))

    return run


def holding_cells(positions: DataFrame, leaf: str, sample: DataFrame, table: DataFrame, cell: str, out: str) -> DataFrame:
    """A row of ``positions`` (without ``leaf``) for each different cell of ``table`` that holds its leaf, in column ``out``.

    ``sample``: some positions with their leaves.  Null leaves and ids that are no cells have no match.
    """
    spark = positions.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    range_of = _range_of(bounds_of(sample, leaf, ranges))
    keep = [c for c in positions.columns if c not in (leaf, out)]
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)))
    own = positions.where(f"`{leaf}` IS NOT NULL").select(
        range_of(leaf).alias("_r"), _hash(positions.select(*(f"`{c}`" for c in keep))).alias("_h"), F.col(leaf).alias("_leaf"), row.alias("_row")
    )
    own = own.select(F.expr("_r.first + CAST(pmod(_h, _r.last - _r.first + 1) AS INT)").alias("_range"), "_leaf", "_row")
    # ids with an even bit set last, on one of the six faces
    is_cell = f"{cells.lsb('_cell')} & 6148914691236517205L <> 0 AND shiftrightunsigned(_cell, 61) < 6 AND _cell <> -9223372036854775807L - 1L"
    held = table.select(F.col(f"`{cell}`").alias("_cell")).where(f"_cell IS NOT NULL AND {is_cell}").distinct()
    held = held.selectExpr("_cell", f"{cells.range_min('_cell')} AS _leaf", f"{cells.range_max('_cell')} AS _last")
    held = held.select("_cell", "_leaf", "_last", range_of("_leaf")["first"].alias("_a"), range_of("_last")["last"].alias("_b"))
    held = held.select(F.explode(F.expr("sequence(_a, _b)")).alias("_range"), "_leaf", "_last", "_cell")
    none = F.lit(None).cast("bigint")
    kind = own.schema["_row"].dataType
    both = own.select("_range", "_leaf", none.alias("_last"), none.alias("_cell"), "_row").unionAll(
        held.select("_range", "_leaf", "_last", "_cell", F.lit(None).cast(kind).alias("_row"))
    )
    dealt = both.repartitionById(ranges, "_range")
    # at one leaf: cells before positions, the widest first
    dealt = dealt.sortWithinPartitions("_range", "_leaf", F.col("_last").desc_nulls_last())
    flat = dealt.select("_range", "_leaf", "_last", "_cell", "_row.*")
    fields = [T.StructField(f"c{k}", positions.schema[c].dataType) for k, c in enumerate(keep)]
    found = flat.mapInArrow(_merge(len(keep)), T.StructType([*fields, T.StructField("_held", T.LongType())]))
    return found.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), F.col("_held").alias(out))
