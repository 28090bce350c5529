"""Raster operations on the metadata, tile, partial and pixel DataFrames of the geotiff source.

Requests name a raster by its path.  Header values come by a join to the metadata table, samples straight from the
blocks that are asked for; a request for a missing file gets the stand-in value below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ..sources.geotiff import SINGULAR, SLICE_BYTES, scan_histograms, with_values

# --- fixed values: results for a missing or unreadable file, and for bad transforms ---
MISSING = {
    "rs_band_count": "0",
    "rs_width": "0",
    "rs_height": "0",
    "rs_nodata": "double('NaN')",
    "rs_geo_transform": "'0,1,0,0,0,-1'",
    "rs_scale_x": "1D",
    "rs_scale_y": "1D",
    "rs_crs": "''",
    "rs_min": "double('Infinity')",
    "rs_max": "double('-Infinity')",
    "rs_mean": "double('NaN')",
    "rs_stddev": "double('NaN')",
}
NO_POINT = "POINT(NaN NaN)"
# -----------------------------------------------------------------------------------------
FIELDS = {
    "rs_band_count": "bands",
    "rs_width": "width",
    "rs_height": "height",
    "rs_nodata": "nodata",
    "rs_geo_transform": "gt_text",
    "rs_scale_x": "gt.gt1",
    "rs_scale_y": "abs(gt.gt5)",
    "rs_crs": "crs",
}
STATS = {"rs_min": "min", "rs_max": "max", "rs_mean": "mean", "rs_stddev": "stddev"}
NAN = "double('NaN')"
# bin of a value above lo; a NaN quotient counts as 0
BIN = "if({w} = 0 OR isnan({w}) OR isnan(value), 0L, floor(try_divide(value - lo, {w})))"


# -- per file -----------------------------------------------------------------------
def rs_metadata(meta: DataFrame) -> DataFrame:
    return meta.select("path", "width", "height", "bands", "crs")


def _with_meta(requests: DataFrame, meta: DataFrame, fields: dict[str, str]) -> DataFrame:
    side = meta.selectExpr("path", *(f"{text} AS {name}" for name, text in fields.items()))
    return requests.join(side, ["path"], "left")


def add_metadata(requests: DataFrame, meta: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Requests (column ``path``) with the named ``rs_*`` header values."""
    names = names or list(FIELDS)
    joined = _with_meta(requests, meta, {n: FIELDS[n] for n in names} | {"_hit": "true"})
    values = [f"if(_hit, {n}, {MISSING[n]}) AS {n}" for n in names]
    return joined.selectExpr(*(f"`{c}`" for c in requests.columns), *values)


def add_band_statistics(requests: DataFrame, partials: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Requests with ``rs_min``, ``rs_max``, ``rs_mean``, ``rs_stddev`` of band 1."""
    names = names or list(STATS)
    stats = rs_stats(partials.where("band = 1")).selectExpr("path", *(f"{STATS[n]} AS {n}" for n in names), "true AS _hit")
    joined = requests.join(stats, ["path"], "left")
    values = [f"if(_hit, {n}, {MISSING[n]}) AS {n}" for n in names]
    return joined.selectExpr(*(f"`{c}`" for c in requests.columns), *values)


_GT = {f"_gt{k}": f"gt.gt{k}" for k in range(6)}
_WORLD_X = "_gt0 + ({c}) * _gt1 + ({r}) * _gt2"
_WORLD_Y = "_gt3 + ({c}) * _gt4 + ({r}) * _gt5"
_DET = "(_gt1 * _gt5 - _gt2 * _gt4)"
_PIXEL_COL = f"(_gt5 * (({{x}}) - _gt0) - _gt2 * (({{y}}) - _gt3)) / {_DET}"
_PIXEL_ROW = f"(-_gt4 * (({{x}}) - _gt0) + _gt1 * (({{y}}) - _gt3)) / {_DET}"


def add_pixel_to_world(
    requests: DataFrame, meta: DataFrame, col: str, row: str, out: str = "rs_pixel_to_world"
) -> DataFrame:
    """World position of pixel coordinates as POINT text, 7 decimals (no half-pixel shift)."""
    x, y = (t.format(c=f"`{col}`", r=f"`{row}`") for t in (_WORLD_X, _WORLD_Y))
    text = f"coalesce(format_string('POINT(%.7f %.7f)', {x}, {y}), '{NO_POINT}')"
    known = f"`{col}` IS NOT NULL AND `{row}` IS NOT NULL AND path IS NOT NULL"
    value = f"CASE WHEN {known} THEN if(_gt0 IS NULL, '{NO_POINT}', {text}) END AS `{out}`"
    return _with_meta(requests, meta, _GT).selectExpr(*(f"`{c}`" for c in requests.columns), value)


def add_world_to_pixel(
    requests: DataFrame, meta: DataFrame, x: str, y: str, out: str = "rs_world_to_pixel"
) -> DataFrame:
    """Pixel position (col row) of world coordinates as POINT text, 3 decimals."""
    c, r = (t.format(x=f"`{x}`", y=f"`{y}`") for t in (_PIXEL_COL, _PIXEL_ROW))
    known = f"`{x}` IS NOT NULL AND `{y}` IS NOT NULL AND path IS NOT NULL"
    value = (
        f"CASE WHEN {known} THEN if(_gt0 IS NULL OR abs({_DET}) < {SINGULAR!r}D, '{NO_POINT}', "
        f"format_string('POINT(%.3f %.3f)', {c}, {r})) END AS `{out}`"
    )
    return _with_meta(requests, meta, _GT).selectExpr(*(f"`{c}`" for c in requests.columns), value)


# -- pixels ----------------------------------------------------------------------------
def add_value(requests: DataFrame, band: str, col: str, row: str, out: str = "rs_value") -> DataFrame:
    """The pixel at (col, row) of a band; NaN beyond the edge or for a missing file.

    Bands are clamped to those there are, negative positions to 0.
    """
    return with_values(requests, "path", band, row, col, out)


def sample_points(points: DataFrame, x: str, y: str, band: int = 1, out: str = "value") -> DataFrame:
    """Raster values under world positions (columns ``path``, ``x``, ``y``); NaN off the raster."""
    banded = points.withColumn("_b", F.lit(band))
    return with_values(banded, "path", "_b", y, x, out, clamp=False, world=True).drop("_b")


def tile_values(tiles: DataFrame) -> DataFrame:
    """Tiles -> (path, band, value), position left out."""
    return tiles.select("path", "band", F.explode("data").alias("value"))


def tile_pixels(tiles: DataFrame) -> DataFrame:
    """Tiles -> (path, band, row, col, value)."""
    long = tiles.select("path", "band", "row0", "col0", "cols", F.posexplode("data").alias("_k", "value"))
    return long.selectExpr(
        "path", "band", "row0 + CAST(_k DIV cols AS INT) AS row", "col0 + _k % cols AS col", "value"
    )


def _finite_bounds(value: str = "value") -> tuple[Column, Column]:
    """Smallest and largest value, NaN left out; infinite when there is none."""
    number = F.when(~F.isnan(value), F.col(value))
    return (
        F.coalesce(F.min(number), F.lit(float("inf"))),
        F.coalesce(F.max(number), F.lit(float("-inf"))),
    )


def pixel_stats(pixels: DataFrame, nodata: str | None = None) -> DataFrame:
    """``min, max, mean, stddev, count`` per (path, band) of rows with a ``value``.

    Every pixel counts; min and max pass over NaN, mean and population standard
    deviation become NaN with it.  ``nodata`` names a column whose value is left out.
    """
    if nodata:
        pixels = pixels.where(f"NOT (value <=> `{nodata}`)")
    low, high = _finite_bounds()
    return pixels.groupBy("path", "band").agg(
        low.alias("min"),
        high.alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("stddev"),
        F.count("*").alias("count"),
    )


# Partials of a raster meet in groups of about its number's root: at most so many groups.
_GROUPS = 1024
_PARTS = "n long, low double, high double, mean double, square double"


def _merged(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of equal keys as one: counts add up, means by weight, squared deviations with the means' distance."""
    listed = partials.groupBy(*keys).agg(F.collect_list(F.struct("n", "low", "high", "mean", "square")).alias("_l"))
    far = "(x.mean - a.mean)"
    both = (
        "named_struct('n', a.n + x.n, 'low', least(a.low, x.low), 'high', greatest(a.high, x.high), "
        f"'mean', a.mean + {far} * x.n / (a.n + x.n), "
        f"'square', a.square + x.square + {far} * {far} * a.n * x.n / (a.n + x.n))"
    )
    first = "named_struct('n', _l[0].n, 'low', _l[0].low, 'high', _l[0].high, 'mean', _l[0].mean, 'square', _l[0].square)"
    merged = listed.selectExpr(*(f"`{k}`" for k in keys), f"aggregate(slice(_l, 2, size(_l)), {first}, (a, x) -> {both}) AS _s")
    return merged.selectExpr(*(f"`{k}`" for k in keys), "_s.*")


def rs_stats(partials: DataFrame) -> DataFrame:
    """``min, max, mean, stddev, count`` per (path, band) from the statistics of its blocks (mode ``partials``).

    Every pixel counts; min and max pass over NaN, mean and population standard deviation become NaN with it.
    """
    spread = partials.withColumn("_g", F.pmod(F.xxhash64("row0", "col0"), F.lit(_GROUPS)))
    whole = _merged(_merged(spread, ["path", "band", "_g"]), ["path", "band"])
    return whole.selectExpr(
        "path", "band", "low AS min", "high AS max", "mean", "sqrt(square / n) AS stddev", "n AS count"
    )


def rs_histogram(pixels: DataFrame, bins: int, bounds: DataFrame | None = None) -> DataFrame:
    """``value`` (bin center) and ``count`` of ``bins`` (2 or more) equal bins per (path, band).

    As the bins are half open, pixels equal to the maximum are in none, except on
    a constant raster, where all are in bin 0, as NaN pixels are.  ``bounds``: ``path, band, min, max``, as of
    ``rs_stats``; without them pixels are read once more.  They are computed once and stored: a row per (path, band).
    """
    bins = max(bins, 2)
    if bounds is None:
        low, high = _finite_bounds()
        bounds = pixels.groupBy("path", "band").agg(low.alias("min"), high.alias("max"))
    bounds = stored(bounds.selectExpr("path", "band", "min AS _lo", f"(max - min) / {bins}D AS _w"))
    placed = pixels.select("path", "band", "value").join(bounds, ["path", "band"])
    placed = placed.withColumnRenamed("_lo", "lo")
    bin_ = BIN.format(w="_w")
    counted = placed.selectExpr("path", "band", f"CAST({bin_} AS INT) AS bin").where(f"bin < {bins}")
    counted = counted.groupBy("path", "band", "bin").agg(F.count("*").alias("count"))
    return _bins(bounds, bins, counted)


def _bins(bounds: DataFrame, bins: int, counted: DataFrame) -> DataFrame:
    """Every bin of every (path, band) with its center and count."""
    every = bounds.selectExpr("*", f"explode(sequence(0, {bins - 1})) AS bin")
    found = every.join(counted, ["path", "band", "bin"], "left")
    return found.selectExpr("path", "band", "bin", "_lo + (bin + 0.5D) * _w AS value", "coalesce(count, 0L) AS count")


def block_histogram(bounds: DataFrame, bins: int, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``rs_histogram`` of the files that ``bounds`` (``path, band, min, max``, as of ``rs_stats``) names.

    The bounds are sent to the files' slices, and each slice gives its counts per bin, which add up: no sample becomes a
    row.  Bounds are computed once and stored.
    """
    bins = max(bins, 2)
    bounds = stored(bounds.selectExpr("path", "band", "min AS _lo", f"(max - min) / {bins}D AS _w"))
    counts = scan_histograms(bounds.selectExpr("path", "band", "_lo AS low", "_w AS width"), bins, slice_bytes)
    counted = counts.select("path", "band", F.posexplode("counts").alias("bin", "count"))
    return _bins(bounds, bins, counted.groupBy("path", "band", "bin").agg(F.sum("count").alias("count")))
