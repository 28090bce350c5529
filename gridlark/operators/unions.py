"""Cell unions over tables: building them per group, area, normal form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells, unions, vectorized
from . import rectcover

# A blob is made by way of 16 hex digits per cell in one text.
MOST_CELLS = (1 << 31) // 16 - 16


def _in_cell_order(ids: str) -> str:
    key = cells.unsigned_order("c")
    return f"transform(array_sort(transform({ids}, c -> {key})), c -> {key})"


def cell_union_counts(df: DataFrame, by: list[str], cell: str) -> DataFrame:
    """The cells of each group's union, copies counted: columns ``by``, ``cell``, ``n``.  Gathers no group."""
    return df.where(f"`{cell}` IS NOT NULL").groupBy(*by, cell).agg(F.count("*").alias("n"))


def cell_union_agg(df: DataFrame, by: list[str], cell: str, out: str = "cells") -> DataFrame:
    """One union blob per group, its cells sorted, copies kept: columns ``by``, ``out``.

    A blob is one value, so a group with more than ``MOST_CELLS`` cells raises an error; ``cell_union_counts`` has no
    such bound.
    """
    if not by:
        return cell_union_agg(df.withColumn("_all", F.lit(0)), ["_all"], cell, out).drop("_all")
    counts = cell_union_counts(df, by, cell).withColumnRenamed(cell, "_c")
    held = counts.groupBy(*by).agg(F.collect_list(F.struct("_c", "n")).alias("_l"), F.sum("n").alias("_total"))
    ids = _in_cell_order("flatten(transform(_l, x -> array_repeat(x._c, CAST(x.n AS INT))))")
    too_many = f"raise_error(concat('a union of ', _total, ' cells is no blob: use cell_union_counts'))"
    keep = [f"`{k}`" for k in by]
    sized = held.selectExpr(*keep, f"if(_total > {MOST_CELLS}, CAST({too_many} AS ARRAY<BIGINT>), {ids}) AS _ids")
    return sized.select(*by, unions.s2_cell_union_of("_ids").alias(out))


def explode_union(df: DataFrame, blob: str, out: str = "cell_id") -> DataFrame:
    """One row per stored cell."""
    keep = [c for c in df.columns if c not in (blob, out)]
    return df.select(*keep, F.explode(unions.s2_cell_union_unpack(blob)).alias(out))


def add_union_area(df: DataFrame, blob: str, out: str = "area_m2") -> DataFrame:
    """``df`` with the area of each row's union (stored cells summed, copies count each time); nothing is shuffled."""
    return df.withColumn(out, vectorized.s2_cell_union_area(F.col(blob)))


def add_union_intersects(df: DataFrame, blob1: str, blob2: str, out: str = "intersects") -> DataFrame:
    """``df`` with whether the unions of each row overlap, by a sweep over their sorted ranges; null for a null blob."""
    return df.withColumn(out, vectorized.s2_cell_union_intersects(F.col(blob1), F.col(blob2)))


def cell_union_area(df: DataFrame, by: list[str], blob: str, out: str = "area_m2") -> DataFrame:
    """Area of unions per key: the areas of its rows added up.  Numbers alone are shuffled."""
    return add_union_area(df.select(*by, blob), blob, "_a").groupBy(*by).agg(F.sum("_a").alias(out))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _normal(ids: pa.Array) -> pa.Array:
    lengths = ids.value_lengths().fill_null(0).to_numpy()
    owner, flat = rectcover.normalize(np.repeat(np.arange(len(ids)), lengths), ids.flatten().to_numpy())
    ends = np.cumsum(np.bincount(owner, minlength=len(ids)))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat, pa.int64()))


def cell_union_normalize(ids: str) -> Column:
    """An array of cells sorted, without nested cells, four siblings merged into their parent."""
    return F.when(F.col(ids).isNotNull(), _normal(F.col(ids)))
