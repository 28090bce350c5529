"""SQL names for the functions: scalars, row generators, and raster look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import functions
from .functions import cells, vectorized, wkt
from .operators import coverings, rasters
from .sources import named
from .sources.geotiff import GeoTiff, value_at


def _define(spark: SparkSession, head: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


# Levels that one step down generates: arrays of at most 4 ** 6 ids.
_STRIDE = 6


def _descended(inner: str, keep: str, level: str) -> str:
    """Query of all descendants ``c`` at ``level`` of the cells ``c`` of a query, a few levels at a time."""
    own, bit = cells.level_of("c"), cells.lsb("c")
    for _ in range(30 // _STRIDE):
        target = cells.level_lsb(f"least({level}, {own} + {_STRIDE})")
        run = f"sequence(c - ({bit} - {target}), c + ({bit} - {target}), 2 * {target})"
        inner = f"SELECT {keep}explode({run}) AS c FROM ({inner})"
    return inner


def register(spark: SparkSession) -> None:
    """The ``s2_*`` functions, as SQL functions; the generators can follow LATERAL."""
    for formula in functions.ALL:
        formula.register(spark)
    for name, udf in vectorized.BY_NAME.items():
        spark.udf.register(name, udf)
    spark.dataSource.register(GeoTiff)
    spark.udf.register("s2_covering_cells", coverings._covering_cells)
    spark.udf.register("s2_interior_cells", coverings._interior_cells)
    spark.udf.register("s2_box_meets_cell", coverings._box_meets_cell)
    levels = "min_level INT, max_level INT"
    box = wkt.bounds("wkt")
    low = "greatest(min_level, 0)"
    own = cells.level_of("c")
    # cells left coarser than the minimum level are split, and those of their descendants kept that meet the box
    found = f"SELECT {box} AS box, explode(s2_covering_cells({box}, {low}, max_level, {coverings.COVERING_CELLS})) AS c"
    marked = f"SELECT box, c, {own} < {low} AS coarse FROM ({found})"
    split = _descended(marked, "box, coarse, ", f"greatest({low}, {own})")
    square = coverings._square.sql("c")
    placed = f"SELECT c, coarse, box, {square} AS q FROM ({split})"
    _define(
        spark,
        f"s2_covering(wkt STRING, {levels}) RETURNS TABLE (cell_id BIGINT)",
        f"SELECT explode(if(NOT coarse OR s2_box_meets_cell(box, q.f, q.i, q.j, {own}), array(c), "
        f"CAST(array() AS ARRAY<BIGINT>))) FROM ({placed})",
    )
    limit = f"greatest(max_cells, {coverings.LEAST_INTERIOR_CELLS})"
    found = f"SELECT explode(s2_interior_cells({box}, {low}, max_level, {limit})) AS c"
    _define(
        spark,
        f"s2_interior_covering(wkt STRING, {levels}, max_cells INT) RETURNS TABLE (cell_id BIGINT)",
        _descended(found, "", f"greatest({low}, {own})"),
    )
    start = f"SELECT explode(if(level BETWEEN {cells.level_of('cell')} AND 30, array(cell), CAST(array() AS ARRAY<BIGINT>))) AS c"
    _define(spark, "s2_children(cell BIGINT, level INT) RETURNS TABLE (child_id BIGINT)", _descended(start, "", "level"))
    _define(
        spark,
        "s2_cell_neighbors(cell BIGINT) RETURNS TABLE (neighbor_id BIGINT)",
        f"SELECT {cells.s2_edge_neighbor.sql('cell', 'k')} FROM (SELECT explode(array(0, 1, 2, 3)) AS k)",
    )


def register_rasters(spark: SparkSession, meta: DataFrame, tiles: DataFrame | None = None) -> None:
    """The ``rs_*`` functions.

    Header values and transforms look the path up in the view ``raster_metadata``; Spark turns each call into a join on
    the path.  ``rs_value``, ``rs_min`` to ``rs_stddev`` and the table functions ``rs_metadata``, ``rs_stats`` and
    ``rs_histogram`` read the named file alone, whether it is in ``meta`` or not; their arguments may be columns
    (``LATERAL``).  ``tiles``, if given, is named as view ``raster_tiles`` and not read by any of them.
    """
    meta.createOrReplaceTempView("raster_metadata")
    if tiles is not None:
        tiles.createOrReplaceTempView("raster_tiles")
    kinds = {"rs_nodata": "DOUBLE", "rs_scale_x": "DOUBLE", "rs_scale_y": "DOUBLE", "rs_geo_transform": "STRING", "rs_crs": "STRING"}
    for name, field in rasters.FIELDS.items():
        args = "file STRING, band INT" if name == "rs_nodata" else "file STRING"
        _define(
            spark,
            f"{name}({args}) RETURNS {kinds.get(name, 'INT')}",
            f"coalesce((SELECT max({field}) FROM raster_metadata WHERE path = file), {rasters.MISSING[name]})",
        )
    spark.udf.register("rs_first_band_stats", named.first_band_stats)
    for name, field in rasters.STATS.items():
        _define(spark, f"{name}(file STRING) RETURNS DOUBLE", f"coalesce(rs_first_band_stats(file).{field}, {rasters.MISSING[name]})")
    gt = {f"_gt{k}": f"max(gt.gt{k})" for k in range(6)}
    one = ", ".join(f"{text} AS {n}" for n, text in gt.items())
    transform = f"(SELECT {one} FROM raster_metadata WHERE path = file)"

    def point(x: str, y: str, digits: int, able: str) -> str:
        text = f"if({able}, format_string('POINT(%.{digits}f %.{digits}f)', {x}, {y}), '{rasters.NO_POINT}')"
        return f"coalesce((SELECT {text} FROM {transform}), '{rasters.NO_POINT}')"

    _define(
        spark,
        "rs_pixel_to_world(file STRING, col DOUBLE, row DOUBLE) RETURNS STRING",
        point(rasters._WORLD_X.format(c="col", r="row"), rasters._WORLD_Y.format(c="col", r="row"), 7, "_gt0 IS NOT NULL"),
    )
    _define(
        spark,
        "rs_world_to_pixel(file STRING, x DOUBLE, y DOUBLE) RETURNS STRING",
        point(
            rasters._PIXEL_COL.format(x="x", y="y"), rasters._PIXEL_ROW.format(x="x", y="y"), 3,
            f"abs({rasters._DET}) >= {rasters.SINGULAR!r}D",
        ),
    )
    spark.udf.register("rs_value", value_at)
    spark.udtf.register("rs_metadata", named.RasterMetadata)
    spark.udtf.register("rs_stats", named.RasterStats)
    spark.udtf.register("rs_histogram", named.RasterHistogram)
