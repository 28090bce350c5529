"""The registered queries: one per function or table operator, over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cells, unions, wkt
from ..operators import coverings, joins, rasters, segments
from ..operators import unions as union_ops
from ..operators.cells import children, neighbors
from ..sources.geotiff import read_geotiff
from ..session import stored
from . import derived

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# -- cells ---------------------------------------------------------------------------
def _leaves(spark: SparkSession, sf: str) -> DataFrame:
    return cells.s2_cell_id.add(derived.points(spark, sf), "leaf", "lat", "lon", 30)


def _cells(spark: SparkSession, sf: str, level: str = "id % 31") -> DataFrame:
    points = derived.points(spark, sf).selectExpr("*", f"CAST({level} AS INT) AS level")
    return cells.s2_cell_id.add(points, "cell", "lat", "lon", "level")


@query
def s2_cell_id(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf).select("id", "level", "cell")


@query
def s2_parent(spark: SparkSession, sf: str) -> DataFrame:
    return cells.s2_parent.add(_leaves(spark, sf), "parent", "leaf", "id % 31").select("id", "parent")


@query
def s2_cell_level(spark: SparkSession, sf: str) -> DataFrame:
    return cells.s2_cell_level.add(_cells(spark, sf), "found", "cell").select("id", "found")


@query
def s2_cell_to_hex(spark: SparkSession, sf: str) -> DataFrame:
    return cells.s2_cell_to_hex.add(_cells(spark, sf), "token", "cell").select("id", "token")


@query
def s2_hex_to_cell(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth token is spoilt."""
    token = cells.s2_cell_to_hex.add(_cells(spark, sf), "token", "cell")
    token = token.selectExpr("id", "if(id % 10 = 3, concat('z', token), token) AS token")
    return cells.s2_hex_to_cell.add(token, "cell", "token").select("id", "cell")


@query
def s2_contains(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of levels 6 to 12 against a position moved a little."""
    cell = _cells(spark, sf, "6 + id % 7")
    return cells.s2_contains.add(cell, "inside", "cell", "lat + (id % 5) * 0.03D", "lon").select("id", "inside")


@query
def s2_distance_meters(spark: SparkSession, sf: str) -> DataFrame:
    cell = cells.s2_cell_id.add(_cells(spark, sf, "10"), "other", "-lat + 0.5D", "lon / 2", 8)
    far = cells.s2_distance_meters.add(cell, "meters", "cell", "other")
    return far.select("id", F.round("meters", 3).alias("meters"))


@query
def s2_area_m2(spark: SparkSession, sf: str) -> DataFrame:
    area = cells.s2_area_m2.add(_leaves(spark, sf), "area", "leaf", "id % 21")
    return area.select("id", F.round(F.col("area") / 1000, 1).alias("area_1000_m2"))


def _as_numbers(df: DataFrame, text: str) -> DataFrame:
    """POINT text as whole 1e-5 degrees, cut where the seventh decimal is rounded."""
    number = "CAST(floor(CAST(regexp_extract({t}, '(-?[0-9.]+) (-?[0-9.]+)', {k}) AS DOUBLE) * 1e5 + 0.125D) AS BIGINT)"
    return df.selectExpr(
        "id", f"{number.format(t=text, k=1)} AS point_lon", f"{number.format(t=text, k=2)} AS point_lat"
    )


@query
def s2_to_geo(spark: SparkSession, sf: str) -> DataFrame:
    return _as_numbers(cells.s2_to_geo.add(_cells(spark, sf), "text", "cell"), "text")


@query
def s2_cell_vertex(spark: SparkSession, sf: str) -> DataFrame:
    cell = _cells(spark, sf, "1 + id % 30")
    return _as_numbers(cells.s2_cell_vertex.add(cell, "text", "cell", "id % 4"), "text")


@query
def s2_cell_id_from_point(spark: SparkSession, sf: str) -> DataFrame:
    """WKT points; every seventh row is some other geometry."""
    text = derived.table(spark, sf, "events").selectExpr(
        "event_id AS id",
        "CASE WHEN event_id % 7 = 4 THEN 'LINESTRING(1 2, 3 4)' ELSE concat('POINT(', "
        "(event_id * 7919) % 360 - 180, '.00713 ', (event_id * 104729) % 168 - 84, '.00317)') END AS wkt",
    )
    return wkt.s2_cell_id_from_point.add(text, "cell", "wkt").select("id", "cell")


@query
def s2_children(spark: SparkSession, sf: str) -> DataFrame:
    return children(_cells(spark, sf, "5 + id % 4").select("id", "cell"), "cell", 8).select("id", "child_id")


@query
def s2_cell_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return neighbors(_cells(spark, sf).select("id", "cell"), "cell").select("id", "neighbor_id")


@query
def s2_covering(spark: SparkSession, sf: str) -> DataFrame:
    return coverings.covering(derived.fences(spark, sf), "wkt", 4, 10).select("fence", "cell_id")


@query
def s2_interior_covering(spark: SparkSession, sf: str) -> DataFrame:
    return coverings.interior_covering(derived.fences(spark, sf), "wkt", 4, 10, 20).select("fence", "cell_id")


# Level at which coverings are listed cell by cell; its cells are smaller than the fences.
LIST_LEVEL = 7


@query
def s2_covering_level(spark: SparkSession, sf: str) -> DataFrame:
    """All cells of one level that meet each fence: a set without choices."""
    return coverings.covering(derived.fences(spark, sf), "wkt", LIST_LEVEL, LIST_LEVEL).select("fence", "cell_id")


@query
def s2_interior_covering_level(spark: SparkSession, sf: str) -> DataFrame:
    """All cells of one level that lie in each fence."""
    fences = derived.fences(spark, sf)
    return coverings.interior_covering(fences, "wkt", LIST_LEVEL, LIST_LEVEL, 10_000).select("fence", "cell_id")


@query
def s2_covering_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points in a fence that its covering holds: all points in the fence, each once."""
    covered = coverings.covering(derived.fences(spark, sf), "wkt", 4, 10)
    boxed = covered.withColumn("_box", F.expr(wkt.bounds("wkt"))).select("fence", "cell_id", "_box.*")
    pairs = joins.points_in_cells(derived.points(spark, sf), stored(boxed), "lat", "lon")
    return pairs.where("lat BETWEEN lat_lo AND lat_hi AND lon BETWEEN lon_lo AND lon_hi").select("id", "fence")


@query
def s2_interior_covering_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points that an interior covering holds but whose fence doesn't: none, so a row per fence with zero."""
    inner = coverings.interior_covering(derived.fences(spark, sf), "wkt", 4, 10, 20)
    boxed = stored(inner.withColumn("_box", F.expr(wkt.bounds("wkt"))).select("fence", "cell_id", "_box.*"))
    pairs = joins.points_in_cells(derived.points(spark, sf), boxed, "lat", "lon")
    outside = F.expr("NOT (lat BETWEEN lat_lo AND lat_hi AND lon BETWEEN lon_lo AND lon_hi)").cast("bigint")
    wrong = pairs.groupBy("fence").agg(F.sum(outside).alias("n"))
    return derived.fences(spark, sf).join(wrong, "fence", "left").selectExpr("fence", "coalesce(n, 0L) AS n_outside")


@query
def s2_bounds_of_collections(spark: SparkSession, sf: str) -> DataFrame:
    """Bounding boxes of fences nested in geometry collections, every fifth one spoilt."""
    nested = "concat('GEOMETRYCOLLECTION(POINT(0 0), GEOMETRYCOLLECTION(', wkt, ', LINESTRING(1 1, 2 2)), POINT(3 3)', if(fence % 5 = 1, '', ')'))"
    boxed = derived.fences(spark, sf).selectExpr("fence", f"{nested} AS wkt")
    return boxed.withColumn("_box", F.expr(wkt.bounds("wkt"))).select("fence", "_box.*")


# -- unions ----------------------------------------------------------------------------
def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Per event, the tokens of its level 8 cell and of a cell elsewhere, twice, and a blank."""
    token = cells.s2_cell_to_hex.sql
    df = cells.s2_cell_id.add(_cells(spark, sf, "8"), "other", "-lat + 0.5D", "lon / 2", 6)
    return df.selectExpr("id", "cell", "other", f"concat({token('cell')}, ', ', {token('other')}, ',,', {token('cell')}) AS csv")


@query
def s2_cell_union_pack(spark: SparkSession, sf: str) -> DataFrame:
    blob = unions.s2_cell_union_pack.add(_tokens(spark, sf), "cells", "csv")
    return blob.selectExpr("id", "lower(hex(cells)) AS blob_hex")


@query
def s2_cell_union_contains(spark: SparkSession, sf: str) -> DataFrame:
    blob = unions.s2_cell_union_pack.add(_tokens(spark, sf), "cells", "csv")
    probe = cells.s2_parent.add(blob, "probe", "if(id % 3 = 0, cell, other)", "5 + id % 4")
    found = unions.s2_cell_union_contains.add(probe, "held", "cells", "probe")
    return found.select("id", "held")


@query
def s2_cell_union_intersects(spark: SparkSession, sf: str) -> DataFrame:
    blob = unions.s2_cell_union_pack.add(_tokens(spark, sf), "cells", "csv")
    probe = cells.s2_parent.add(blob, "up", "cell", "id % 9")
    probe = probe.withColumn("up", F.expr("if(id % 2 = 0, up, up ^ shiftleft(1L, 61))"))
    probe = unions.s2_cell_union_of.add(probe, "others", "array(up)")
    return union_ops.add_union_intersects(probe, "cells", "others", "met").select("id", "met")


@query
def s2_cell_union_area(spark: SparkSession, sf: str) -> DataFrame:
    blob = unions.s2_cell_union_pack.add(_tokens(spark, sf), "cells", "csv")
    area = union_ops.add_union_area(blob, "cells", "area")
    return area.select("id", F.round(F.col("area") / 1e6, 1).alias("area_km2"))


@query
def cell_union_agg(spark: SparkSession, sf: str) -> DataFrame:
    """One sorted union per event type."""
    blob = union_ops.cell_union_agg(_typed(spark, sf), ["event_type"], "cell")
    return blob.selectExpr("event_type", "octet_length(cells) AS n_bytes", "md5(hex(cells)) AS digest")


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    points = derived.points(spark, sf, "event_type")
    return cells.s2_cell_id.add(points, "cell", "lat", "lon", 6).select("event_type", "cell")


@query
def cell_union_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same unions as rows: how often each cell occurs."""
    return union_ops.cell_union_counts(_typed(spark, sf), ["event_type"], "cell")


@query
def s2_cell_union_unpack(spark: SparkSession, sf: str) -> DataFrame:
    blob = unions.s2_cell_union_pack.add(_tokens(spark, sf), "cells", "csv")
    return blob.select("id", F.posexplode(unions.s2_cell_union_unpack("cells")).alias("place", "cell"))


@query
def cell_union_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Per event, a cell, its four children and a grandchild elsewhere: nested, doubled and mergeable."""
    cell = _cells(spark, sf, "3 + id % 5")
    lsb = cells.lsb("cell")
    below = f"transform(array(-3, -1, 1, 3), k -> cell + k * ({lsb} DIV 4))"
    ids = f"CASE id % 3 WHEN 0 THEN concat({below}, array(cell + {lsb} DIV 4)) WHEN 1 THEN array(cell, cell, cell - {lsb} DIV 4) ELSE slice({below}, 1, 3) END"
    made = cell.selectExpr("id", f"{ids} AS ids")
    return made.select("id", F.explode(union_ops.cell_union_normalize("ids")).alias("cell"))


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of few levels per event type, so that many nest, repeat, and make up their parents."""
    points = derived.points(spark, sf, "event_type").selectExpr("*", "CAST(1 + id % 4 AS INT) AS level")
    return cells.s2_cell_id.add(points, "cell", "lat", "lon", "level").select("event_type", "cell")


@query
def cell_union_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The unions of the event types in segments below level 3: directory and checksum of the ids."""
    rows = segments.cell_union_segments(_dense(spark, sf), ["event_type"], "cell", 3)
    return rows.selectExpr("event_type", "wide", "segment", "first", "last", "n", "md5(array_join(CAST(ids AS ARRAY<STRING>), ',')) AS digest")


@query
def cell_union_segments_contain(spark: SparkSession, sf: str) -> DataFrame:
    """For each event's cell at another level, whether the union of its type holds it."""
    points = derived.points(spark, sf, "event_type").selectExpr("*", "CAST(id % 7 AS INT) AS level")
    asked = cells.s2_cell_id.add(points, "cell", "lat", "lon", "level").select("id", "event_type", "cell")
    parts = segments.cell_union_segments(_dense(spark, sf), ["event_type"], "cell", 3)
    return segments.segments_contain(parts, asked, ["event_type"], "cell", "held", 3).select("id", "held")


@query
def s2_cell_union_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """The unions of the event types in normal form, as rows."""
    return segments.normalized(_dense(spark, sf), ["event_type"], "cell", 3)


# -- joins -----------------------------------------------------------------------------
@query
def s2_point_in_cells_join(spark: SparkSession, sf: str) -> DataFrame:
    places = derived.places(spark, sf).selectExpr("*", "CAST(4 + place % 4 AS INT) AS level")
    table = cells.s2_cell_id.add(places, "cell_id", "lat", "lon", "level").select("place", "cell_id")
    return joins.points_in_cells(derived.points(spark, sf), table, "lat", "lon").select("id", "place", "cell_id")


@query
def s2_point_in_fences_join(spark: SparkSession, sf: str) -> DataFrame:
    found = joins.points_in_fences(
        derived.points(spark, sf), derived.fences(spark, sf), "fence", "wkt", "lat", "lon", 0, 12
    )
    return found.select("id", "fence")


@query
def s2_cell_density(spark: SparkSession, sf: str) -> DataFrame:
    return joins.cell_density(derived.points(spark, sf), "lat", "lon", [4, 6, 8])


@query
def s2_neighbor_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose level 5 cell is adjacent to the cell of an event, with the number of events."""
    left = cells.s2_cell_id.add(derived.places(spark, sf), "cell", "lat", "lon", 5).select("place", "cell")
    right = cells.s2_cell_id.add(derived.points(spark, sf), "near", "lat", "lon", 5)
    right = right.groupBy("near").agg(F.count("*").alias("n"))
    return joins.neighbor_join(left, right, "cell", "near").groupBy("place").agg(F.sum("n").alias("n_near"))


@query
def s2_union_overlap_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customer regions (cells of levels 4 to 7) against user regions (levels 3 to 8)."""
    places = derived.places(spark, sf).selectExpr("place % 100 AS region", "lat", "lon", "CAST(4 + place % 4 AS INT) AS level")
    left = cells.s2_cell_id.add(places, "cell_id", "lat", "lon", "level").select("region", "cell_id")
    users = derived.points(spark, sf).selectExpr("id % 100 AS user", "lat", "lon", "CAST(3 + id % 6 AS INT) AS level", "id")
    right = cells.s2_cell_id.add(users, "cell_id", "lat", "lon", "level")
    return joins.union_overlap_join(left, right.select("user", "cell_id"), "region", "user")


# -- rasters ----------------------------------------------------------------------------
def _meta(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    folder = derived.rasters(spark, sf)
    return folder, read_geotiff(spark, folder, "metadata")


def _named(df: DataFrame, *columns: str) -> DataFrame:
    return df.selectExpr(f"{derived.file_name()} AS file", *columns)


@query
def rs_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return _named(rasters.rs_metadata(_meta(spark, sf)[1]), "width", "height", "bands", "crs")


def _header_query(name: str, shown: str | None = None) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        folder, meta = _meta(spark, sf)
        requests = derived.pixel_requests(spark, sf, folder)
        return rasters.add_metadata(requests, meta, [name]).selectExpr("id", f"{shown or name} AS {name}")

    QUERIES[name] = run


for _name in ("rs_width", "rs_height", "rs_band_count", "rs_geo_transform", "rs_scale_x", "rs_scale_y", "rs_crs"):
    _header_query(_name)
_header_query("rs_nodata", "if(isnan(rs_nodata), NULL, rs_nodata)")


@query
def rs_value(spark: SparkSession, sf: str) -> DataFrame:
    requests = derived.pixel_requests(spark, sf, derived.rasters(spark, sf))
    found = rasters.add_value(requests, "band", "col", "row")
    return found.selectExpr("id", "if(isnan(rs_value), NULL, rs_value) AS value")


@query
def rs_pixel_to_world(spark: SparkSession, sf: str) -> DataFrame:
    folder, meta = _meta(spark, sf)
    requests = derived.pixel_requests(spark, sf, folder).selectExpr("*", "col + 0.5D AS c", "row + 0.25D AS r")
    found = rasters.add_pixel_to_world(requests, meta, "c", "r", "text")
    return found.selectExpr("id", "text AS point_text")


@query
def rs_world_to_pixel(spark: SparkSession, sf: str) -> DataFrame:
    folder, meta = _meta(spark, sf)
    requests = derived.pixel_requests(spark, sf, folder).selectExpr("*", "col * 2.5D AS x", "row * 1.5D AS y")
    found = rasters.add_world_to_pixel(requests, meta, "x", "y", "text")
    number = "try_cast(regexp_extract(text, '(-?[0-9.]+) (-?[0-9.]+)', {}) AS DOUBLE)"
    return found.selectExpr("id", *(f"round({number.format(k)}, 2) AS {n}" for k, n in ((1, "pixel_col"), (2, "pixel_row"))))


@query
def rs_sample_points(spark: SparkSession, sf: str) -> DataFrame:
    """Raster values under world positions."""
    requests = derived.pixel_requests(spark, sf, derived.rasters(spark, sf))
    n = "CAST(regexp_extract(path, 'r([0-9]+).tif$', 1) AS BIGINT)"
    world = requests.selectExpr(
        "id", "path", f"10D * {n} + 0.5D + (col + 0.5D) * 0.25D AS x", f"60D - {n} - (row + 0.5D) * (0.5D + {n} % 3) AS y"
    )
    found = rasters.sample_points(world, "x", "y", 1)
    return found.selectExpr("id", "if(isnan(value), NULL, value) AS value")


@query
def rs_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = rasters.rs_stats(read_geotiff(spark, derived.rasters(spark, sf), "partials"))
    rounded = (f"round({n}, 6) AS {n}" for n in ("min", "max", "mean", "stddev"))
    return _named(stats, "band", *rounded, "count")


@query
def rs_histogram(spark: SparkSession, sf: str) -> DataFrame:
    folder = derived.rasters(spark, sf)
    bounds = rasters.rs_stats(read_geotiff(spark, folder, "partials"))
    bins = rasters.block_histogram(bounds, 16)
    return _named(bins, "band", "bin", "round(value, 6) AS value", "count")


@query
def rs_stats_without_nodata(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of all pixels but those of one value: the label part of band 2."""
    pixels = rasters.tile_values(read_geotiff(spark, derived.rasters(spark, sf), bands="2"))
    stats = rasters.pixel_stats(pixels.withColumn("nodata", F.lit(4.0)), "nodata")
    return _named(stats, "min", "max", "round(mean, 6) AS mean", "round(stddev, 6) AS stddev", "count")


@query
def rs_stats_without_header_nodata(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics without each file's own NoData, from the statistics of its blocks."""
    folder = derived.rasters(spark, sf, own_nodata=True)
    stats = rasters.rs_stats(read_geotiff(spark, folder, "partials", ignoreNodata="true"))
    rounded = (f"round({n}, 6) AS {n}" for n in ("min", "max", "mean", "stddev"))
    return _named(stats, "band", *rounded, "count")


def _band_query(name: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        folder = derived.rasters(spark, sf)
        requests = derived.pixel_requests(spark, sf, folder)
        partials = read_geotiff(spark, folder, "partials", bands="1")
        found = rasters.add_band_statistics(requests, partials, [name])
        rounded = f"if(isnan({name}) OR abs({name}) = double('Infinity'), NULL, round({name}, 6)) AS {name}"
        return found.selectExpr("id", rounded)

    QUERIES[name] = run


for _name in ("rs_min", "rs_max", "rs_mean", "rs_stddev"):
    _band_query(_name)


@query
def rs_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Every pixel of every band of every file."""
    pixels = read_geotiff(spark, derived.rasters(spark, sf), "pixels")
    return _named(pixels, "band", "row AS pixel_row", "col AS pixel_col", "value")


@query
def rs_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels by way of tiles: per file, band and row."""
    pixels = rasters.tile_pixels(read_geotiff(spark, derived.rasters(spark, sf)))
    rows = pixels.groupBy("path", "band", "row").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return _named(rows, "band", "row AS pixel_row", "n", "total")
