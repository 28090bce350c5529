import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tiffs import write_tiff

from gridlark.operators import rasters
from gridlark.plans import derived
from gridlark.sources.geotiff import list_files, read_geotiff, scan_geotiff
from gridlark.sources.tiff import Tiff

GRID = np.arange(12, dtype=np.float32).reshape(3, 4)


def pixels_of(spark, path, **options):
    rows = read_geotiff(spark, path, "pixels", **options).collect()
    out = {}
    for r in rows:
        assert (r.band, r.row, r.col) not in out
        out[r.band, r.row, r.col] = r.value
    return out


def expect(data):
    data = data[..., None] if data.ndim == 2 else data
    return {(b + 1, r, c): float(v) for (r, c, b), v in np.ndenumerate(data)}


def test_metadata(spark, tmp_path):
    write_tiff(tmp_path / "a.tif", GRID, tie=(100, 50), scale=(0.5, 0.25), keys=[(1024, 2), (2048, 4326)], nodata="-9999")
    write_tiff(tmp_path / "b.tif", GRID.astype("u1"))
    write_tiff(tmp_path / "c.tif", np.zeros((5, 6, 3), "u1"), metadata="x=1\nNODATA=-1\nNoData=7", order=">",
               keys=[(2048, 4326), (3072, 32650)], tie=(0.1, 1e-7), scale=(1e21, 100.0))
    write_tiff(tmp_path / "d.tif", GRID, nodata="bad", metadata="NODATA=3", big=True, scale=(0.0, 0.0), keys=[(3072, 3857)])
    rows = {r.path[-5:]: r for r in read_geotiff(spark, str(tmp_path), "metadata").collect()}
    a, b, c, d = (rows[f"{n}.tif"] for n in "abcd")
    assert (a.width, a.height, a.bands, a.gt_text, a.crs, a.nodata) == (4, 3, 1, "100,0.5,0,50,0,-0.25", "EPSG:4326", -9999)
    assert tuple(a.gt) == (100, 0.5, 0, 50, 0, -0.25)
    assert (b.gt_text, b.crs) == ("0,1,0,0,0,-1", "See GeoTIFF tags") and math.isnan(b.nodata)
    assert (c.width, c.height, c.bands, c.crs, c.nodata) == (6, 5, 3, "EPSG:4326", -1)
    assert c.gt_text == "0.1,1000000000000000000000,0,0.0000001,0,-100"
    assert d.crs == "EPSG:3857" and math.isnan(d.nodata) and d.gt_text == "0,0,0,0,0,-0"


LAYOUTS = [
    {},
    {"rows_per_strip": 7},
    {"order": ">"},
    {"order": ">", "rows_per_strip": 1, "big": True},
    {"tile": (16, 16)},
    {"tile": (16, 32), "planar": True},
    {"planar": True, "rows_per_strip": 4},
]


@pytest.mark.parametrize("compression", [1, 8, 32773, 5])
def test_layouts(spark, tmp_path, compression):
    rng = np.random.default_rng(compression)
    want = {}
    for k, layout in enumerate(LAYOUTS):
        for kind in ("u1", "u2", "f4", "f8", "i2", "u4"):
            data = rng.integers(0, 100, (20, 37, 3)).astype(kind)
            name = f"{k}_{kind}.tif"
            write_tiff(tmp_path / name, data, compression=compression, **layout)
            want[name] = data
    write_tiff(tmp_path / "p.tif", want["0_u2.tif"], compression=compression, predictor=2, rows_per_strip=5)
    want["p.tif"] = want["0_u2.tif"]
    # small tiles and slices: every piece must land in its place, once
    df = read_geotiff(spark, str(tmp_path), "tiles", maxTilePixels=100, partitionBytes=3000)
    pixels = rasters.tile_pixels(df).groupBy("path", "band").agg(F.sort_array(F.collect_list(F.struct("row", "col", "value"))).alias("l"))
    got = {}
    for r in pixels.collect():
        got.setdefault(r.path.rsplit("/", 1)[1], {}).update({(r.band, p.row, p.col): p.value for p in r.l})
    counts = df.selectExpr("sum(size(data)) AS n", "max(size(data)) AS m").first()
    assert counts.n == sum(d.size for d in want.values()) and counts.m <= 100 * 16
    assert got == {n: expect(d) for n, d in want.items()}


def test_lzw_over_many_codes(spark, tmp_path):
    data = np.random.default_rng(1).integers(0, 255, (150, 150)).astype("u1")
    path = write_tiff(tmp_path / "l.tif", data, compression=5)
    assert pixels_of(spark, path) == expect(data)


def test_pruning_options(spark, tmp_path):
    data = np.arange(64 * 64 * 2, dtype="f4").reshape(64, 64, 2)
    path = write_tiff(tmp_path / "t.tif", data, tile=(16, 16))
    got = pixels_of(spark, path, bands="2", rows="20-40", cols="0-3")
    assert {k[0] for k in got} == {2}
    assert {k[1] for k in got} == set(range(16, 48)) and {k[2] for k in got} == set(range(16))


def test_two_uses_of_one_dataframe(spark, tmp_path):
    data = np.arange(8, dtype="f4").reshape(2, 2, 2)
    df = read_geotiff(spark, write_tiff(tmp_path / "t.tif", data), "pixels")
    both = df.where("band = 1").alias("a").join(df.where("band = 2").alias("b"), ["row", "col"])
    assert both.selectExpr("b.value - a.value AS d").distinct().collect() == [(1.0,)]


def test_errors(spark, tmp_path):
    (tmp_path / "bad.tif").write_bytes(b"not a tiff")
    write_tiff(tmp_path / "jpeg.tif", GRID, compression=1, extra=())
    good = write_tiff(tmp_path / "good.tif", GRID)
    with pytest.raises(Exception, match="Cannot open"):
        read_geotiff(spark, str(tmp_path / "none.tif"), "metadata").collect()
    with pytest.raises(Exception, match="not a TIFF"):
        read_geotiff(spark, str(tmp_path / "bad.tif"), "metadata").collect()
    assert read_geotiff(spark, str(tmp_path / "none.tif"), "metadata", onError="skip").count() == 0
    assert read_geotiff(spark, [good, str(tmp_path / "bad.tif")], "metadata", onError="skip").count() == 1
    half = write_tiff(tmp_path / "half.tif", GRID.astype(np.float16).astype("f4"))
    assert pixels_of(spark, half) == expect(GRID)
    assert len(list_files(str(tmp_path / "g*.tif"))) == 1 and len(list_files(str(tmp_path))) == 4


def test_scan_of_a_table_of_paths(spark, tmp_path):
    paths = [write_tiff(tmp_path / f"{k}.tif", GRID + k) for k in range(5)] + ["/none.tif"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert scan_geotiff(files, "path", "metadata").count() == 5
    assert scan_geotiff(files, "path", "pixels").agg(F.sum("value")).first()[0] == 5 * 66 + 12 * 10


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("r")
    data = np.arange(30 * 20 * 2, dtype="f4").reshape(30, 20, 2)
    a = write_tiff(folder / "a.tif", data, tile=(16, 16), tie=(100, 50), scale=(0.5, 0.25), nodata="4")
    b = write_tiff(folder / "b.tif", GRID, scale=(0.0, 0.0))
    options = {"maxTilePixels": 64}
    meta = read_geotiff(spark, str(folder), "metadata", **options).cache()
    return a, b, data, meta, read_geotiff(spark, str(folder), "tiles", **options).cache()


def test_value(spark, place):
    a, b, data, meta, tiles = place
    rows = [(a, 1, 3, 4), (a, 2, 19, 29), (a, 9, 0, 0), (a, 0, 5, 17), (a, 1, -4, -1), (a, 1, 20, 0), (a, 1, 0, 30),
            (b, 1, 3, 2), ("none", 1, 0, 0), (a, None, 1, 1), (a, 1, None, 1)]
    want = [data[4, 3, 0], data[29, 19, 1], data[0, 0, 1], data[17, 5, 0], data[0, 0, 0], math.nan, math.nan,
            11.0, math.nan, None, None]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, path string, b int, c int, r int")
    got = [x.rs_value for x in rasters.add_value(df, "b", "c", "r").orderBy("k").collect()]
    for g, w in zip(got, want, strict=True):
        assert (g is None) == (w is None) and (g is None or g == w or (math.isnan(g) and math.isnan(w)))


def test_transforms(spark, place):
    a, b, _, meta, tiles = place
    rows = [(0, a, 3.0, 4.5), (1, b, 3.0, 4.5), (2, "none", 1.0, 1.0), (3, a, None, 1.0), (4, a, 100.0, 50.0)]
    df = spark.createDataFrame(rows, "k int, path string, x double, y double")
    got = rasters.add_pixel_to_world(df, meta, "x", "y", "w")
    got = rasters.add_world_to_pixel(got, meta, "x", "y", "p").orderBy("k").collect()
    assert [r.w for r in got] == ["POINT(101.5000000 48.8750000)", "POINT(0.0000000 0.0000000)", "POINT(NaN NaN)", None,
                                  "POINT(150.0000000 37.5000000)"]
    assert [r.p for r in got] == ["POINT(-194.000 182.000)", "POINT(NaN NaN)", "POINT(NaN NaN)", None, "POINT(0.000 -0.000)"]
    world = spark.createDataFrame([(0, a, 100.7, 49.6), (1, a, 99.9, 49.6), (2, b, 1.0, 1.0), (3, "none", 1.0, 1.0)],
                                  "k int, path string, x double, y double")
    values = [r.value for r in rasters.sample_points(world, "x", "y").orderBy("k").collect()]
    assert values[0] == 1 * 40 + 1 * 2 and all(map(math.isnan, values[1:]))


def test_header_values_and_stand_ins(spark, place):
    a, _, _, meta, tiles = place
    df = spark.createDataFrame([(a,), ("none",)], "path string")
    got = {r.path: r for r in rasters.add_metadata(df, meta).collect()}
    assert tuple(got[a])[1:] == (2, 20, 30, 4.0, "100,0.5,0,50,0,-0.25", 0.5, 0.25, "See GeoTIFF tags")
    none = tuple(got["none"])[1:]
    assert none[:3] == (0, 0, 0) and math.isnan(none[3]) and none[4:] == ("0,1,0,0,0,-1", 1.0, 1.0, "")
    partials = read_geotiff(spark, a, "partials")
    stats = {r.path: r for r in rasters.add_band_statistics(df, partials).collect()}
    assert (stats[a].rs_min, stats[a].rs_max, stats[a].rs_mean) == (0, 1198, 599)
    assert (stats["none"].rs_min, stats["none"].rs_max) == (math.inf, -math.inf) and math.isnan(stats["none"].rs_mean)
    assert rasters.rs_metadata(meta).columns == ["path", "width", "height", "bands", "crs"]


def pixel_table(spark, values):
    rows = [(p, 1, float(v)) for p, vs in values.items() for v in vs]
    return spark.createDataFrame(rows, "path string, band int, value double")


def test_stats(spark):
    nan = math.nan
    df = pixel_table(spark, {"p": [1, 2, 3, 5], "n": [1, nan, 3], "c": [7, 7], "x": [nan, nan]})
    got = {r.path: r for r in rasters.pixel_stats(df).collect()}
    assert tuple(got["p"])[2:5] == (1, 5, 2.75) and got["p"].stddev == pytest.approx(np.std([1, 2, 3, 5])) and got["p"]["count"] == 4
    assert (got["n"].min, got["n"].max, got["n"]["count"]) == (1, 3, 3) and math.isnan(got["n"].mean) and math.isnan(got["n"].stddev)
    assert (got["c"].stddev, got["c"].mean) == (0, 7)
    assert (got["x"].min, got["x"].max) == (math.inf, -math.inf)
    left = rasters.pixel_stats(df.withColumn("nd", F.lit(5.0)), nodata="nd").where("path = 'p'").first()
    assert (left.max, left["count"]) == (3, 3)


def test_stats_from_partials(spark, tmp_path):
    rng = np.random.default_rng(6)
    data = (1e6 + rng.random((70, 45, 2))).astype("f8")
    odd = data.copy()
    odd[3, 4, 1] = np.nan
    write_tiff(tmp_path / "a.tif", data, tile=(16, 16))
    write_tiff(tmp_path / "b.tif", odd, rows_per_strip=7)
    write_tiff(tmp_path / "c.tif", np.full((9, 9, 1), np.nan))
    partials = read_geotiff(spark, str(tmp_path), "partials", maxTilePixels=100)
    assert partials.count() > 40
    got = {(r.path[-5], r.band): r for r in rasters.rs_stats(partials).collect()}
    for name, values in (("a", data), ("b", odd)):
        for band in (0, 1):
            r, v = got[name, band + 1], values[..., band]
            assert (r.min, r.max, r["count"]) == (np.nanmin(v), np.nanmax(v), v.size)
            if np.isnan(v).any():
                assert math.isnan(r.mean) and math.isnan(r.stddev)
            else:
                assert r.mean == pytest.approx(v.mean(), rel=1e-13) and r.stddev == pytest.approx(v.std(), rel=1e-6)
    assert (got["c", 1].min, got["c", 1].max) == (math.inf, -math.inf)


def test_unequal_options_give_equal_values(spark, tmp_path):
    """Look-ups need neither table; pieces of any size hold the same pixels."""
    data = np.arange(40 * 50, dtype="f4").reshape(40, 50)
    path = write_tiff(tmp_path / "a.tif", data, rows_per_strip=40)
    df = spark.range(300).selectExpr(f"'{path}' AS path", "1 AS b", "CAST(id % 55 AS INT) AS c", "CAST(id % 43 AS INT) AS r")
    for r in rasters.add_value(df, "b", "c", "r").collect():
        on = r.c < 50 and r.r < 40
        assert r.rs_value == data[r.r, r.c] if on else math.isnan(r.rs_value)
    grids = {tuple(read_geotiff(spark, path, "metadata", maxTilePixels=n).select("block_rows", "block_cols").first()) for n in (16, 1 << 18)}
    assert grids == {(40, 50)}


def test_floating_point_predictor(spark, tmp_path):
    rng = np.random.default_rng(3)
    for layout in range(8):
        data = rng.normal(size=(33, 64, 2))
        (tmp_path / f"{layout}.tif").write_bytes(derived._geotiff(data, (0, 0), (1, 1), 4326, None, layout))
        kind = "f8" if layout % 3 == 1 else "f4"
        assert pixels_of(spark, str(tmp_path / f"{layout}.tif")) == expect(data.astype(kind))


def test_each_file_is_decoded_once(spark, tmp_path):
    """Counted by a file that each opening adds a line to."""
    log = tmp_path / "log"
    path = write_tiff(tmp_path / "a.tif", GRID)

    def count(run):
        log.write_text("")
        opened = Tiff.__init__

        def noted(self, path, max_pixels=1 << 18, _opened=opened, _log=str(log)):
            with open(_log, "a") as f:
                f.write("x")
            _opened(self, path, max_pixels)

        Tiff.__init__ = noted
        try:
            run()
        finally:
            Tiff.__init__ = opened
        return len(log.read_text())

    df = spark.createDataFrame([(path, 1, k % 4, k % 3) for k in range(50)], "path string, b int, c int, r int").coalesce(1)
    folder = str(tmp_path / "a.tif")
    # regions of 512 pixels: one here
    assert count(lambda: rasters.add_value(df, "b", "c", "r").collect()) == 1
    assert count(lambda: rasters.add_metadata(df, read_geotiff(spark, folder, "metadata"), ["rs_width"]).collect()) == 1
    assert count(lambda: rasters.add_band_statistics(df, read_geotiff(spark, folder, "partials"), ["rs_min"]).collect()) == 1
    bounds = lambda: rasters.rs_stats(read_geotiff(spark, folder, "partials"))
    assert count(lambda: rasters.rs_histogram(rasters.tile_values(read_geotiff(spark, folder)), 4, bounds()).collect()) == 2


def test_histogram(spark):
    nan = math.nan
    df = pixel_table(spark, {"p": [1, 2, 3, 5], "n": [1, nan, 3], "c": [7, 7], "x": [nan, nan]})
    got = {}
    for r in rasters.rs_histogram(df, 4).orderBy("bin").collect():
        got.setdefault(r.path, []).append((r.value, r["count"]))
    assert got["p"] == [(1.5, 1), (2.5, 1), (3.5, 1), (4.5, 0)]
    assert got["c"] == [(7, 2), (7, 0), (7, 0), (7, 0)]
    assert got["n"] == [(1.25, 2), (1.75, 0), (2.25, 0), (2.75, 0)]
    assert [n for _, n in got["x"]] == [2, 0, 0, 0] and all(math.isnan(v) for v, _ in got["x"])
    assert rasters.rs_histogram(df.where("path = 'p'"), 0).count() == 2


def test_block_histograms_equal_pixel_histograms(spark, tmp_path):
    """Over files of several layouts, NaN and constant bands, whole and in slices."""
    rng = np.random.default_rng(3)
    a = rng.normal(0, 9, (70, 45, 2)).astype("f8")
    a[3, 4, 0] = math.nan
    b = np.full((20, 30, 2), 7.0)
    b[..., 1] = math.nan
    write_tiff(tmp_path / "a.tif", a, tile=(16, 16))
    write_tiff(tmp_path / "b.tif", b)
    write_tiff(tmp_path / "c.tif", a[:33], tile=(32, 16))
    for slice_bytes in (1 << 26, 3000):
        bounds = rasters.rs_stats(read_geotiff(spark, str(tmp_path), "partials"))
        got = rasters.block_histogram(bounds, 7, slice_bytes).collect()
        want = rasters.rs_histogram(rasters.tile_values(read_geotiff(spark, str(tmp_path))), 7, bounds).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 42
    plan = rasters.block_histogram(bounds, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(counts" in plan and "explode(data" not in plan


def test_statistics_without_the_files_own_nodata(spark, tmp_path):
    rng = np.random.default_rng(8)
    data = rng.integers(0, 6, (40, 50, 2)).astype("f8")
    data[:16, :16] = 3  # a block of NoData alone
    tags = {"a": {"nodata": "3"}, "b": {"metadata": "X=1\nNODATA=3"}, "c": {}, "d": {"nodata": "bad"}}
    for name, more in tags.items():
        write_tiff(tmp_path / f"{name}.tif", data, tile=(16, 16), **more)
    holes = data.copy()
    holes[::2] = math.nan
    write_tiff(tmp_path / "e.tif", holes, tile=(16, 16))
    write_tiff(tmp_path / "f.tif", np.full((20, 20, 1), 3.0), nodata="3")
    found = rasters.rs_stats(read_geotiff(spark, str(tmp_path), "partials", ignoreNodata="true")).collect()
    got = {(r.path[-5], r.band): r for r in found}
    for name, source, keep in (("a", data, data != 3), ("b", data, data != 3), ("c", data, data > -1), ("d", data, data > -1), ("e", holes, ~np.isnan(holes))):
        for band in (0, 1):
            v, r = source[..., band][keep[..., band]], got[name, band + 1]
            assert (r.min, r.max, r["count"]) == (v.min(), v.max(), len(v))
            assert r.mean == pytest.approx(v.mean()) and r.stddev == pytest.approx(v.std())
    assert ("f", 1) not in got  # no pixel has a value
    with pytest.raises(Exception, match="ignoreNodata"):
        read_geotiff(spark, str(tmp_path), "tiles", ignoreNodata="true").count()


def test_a_large_file_of_a_table_of_paths_is_shared(spark, tmp_path):
    data = np.arange(64 * 64, dtype="f8").reshape(64, 64, 1)
    path = write_tiff(tmp_path / "a.tif", data, tile=(16, 16))
    files = spark.createDataFrame([(str(path or tmp_path / "a.tif"),), (None,), (str(tmp_path / "none.tif"),)], "path string")
    rows = scan_geotiff(files, "path", "pixels", slice_bytes=5000)
    tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1 and rows.count() == 64 * 64 and rows.agg(F.sum("value")).first()[0] == data.sum()
    with pytest.raises(Exception, match="Cannot open"):
        scan_geotiff(files, "path", "pixels", skip_errors=False).count()


def test_a_failing_store_fails_the_task(spark, tmp_path, monkeypatch):
    """An absent file has no value; an error of its store isn't taken for that."""
    data = np.ones((4, 4, 1))
    write_tiff(tmp_path / "a.tif", data)
    name = str(tmp_path / "a.tif")
    df = spark.createDataFrame([(name, 1, 0, 0), (name + "x", 1, 0, 0)], "path string, b int, c int, r int").coalesce(1)
    assert [r.rs_value == 1 or math.isnan(r.rs_value) for r in rasters.add_value(df, "b", "c", "r").collect()] == [True, True]

    def failing(self, path, max_pixels=1 << 18):
        raise TimeoutError("the store does not answer")

    monkeypatch.setattr(Tiff, "__init__", failing)
    with pytest.raises(Exception, match="does not answer"):
        rasters.add_value(df, "b", "c", "r").collect()
