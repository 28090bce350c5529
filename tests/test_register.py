"""The SQL names, in the statements a user of them would write."""

import math

import numpy as np
import published
import pytest
from published import EAST, HERE, NEAR_HERE
from tiffs import write_tiff

from gridlark import functions
from gridlark.operators.coverings import covering
from gridlark.register import register, register_rasters
from gridlark.sources.geotiff import read_geotiff
from gridlark.sources.tiff import Tiff

BEIJING = f"'{published.BEIJING}'"
COARSE, FINE = published.LEVELS


@pytest.fixture(scope="module")
def sql(spark):
    register(spark)
    return lambda text: [tuple(r) for r in spark.sql(text).collect()]


def test_scalars(sql):
    cell = f"s2_cell_id({HERE}, {FINE})"
    south = "s2_cell_id(-89.9, 12.5, 3)"  # on face 5: a negative id
    assert sql(f"SELECT {cell}, {south} < 0")[0] == (3886697737885843456, True)
    assert sql(f"SELECT s2_contains({cell}, {NEAR_HERE}), s2_contains({cell}, {EAST}), s2_contains({south}, -90, 0)")[0] == (True, False, True)
    far = sql(f"SELECT s2_distance_meters(s2_cell_id({HERE}, {COARSE}), s2_cell_id({EAST}, {COARSE}))")[0][0]
    assert far == pytest.approx(54_000, rel=0.5)
    assert sql(f"SELECT s2_parent({cell}, {COARSE}) = s2_cell_id({HERE}, {COARSE}), s2_parent({south}, 31)")[0] == (True, None)
    assert sql(f"SELECT s2_area_m2({cell}, {FINE})")[0][0] == pytest.approx(7.3e7, rel=0.2)
    assert sql(f"SELECT s2_cell_level({cell}), s2_cell_level({south})")[0] == (FINE, 3)
    assert sql(f"SELECT s2_to_geo({cell}), s2_cell_vertex({cell}, 0)")[0] == (
        "POINT(116.3721711 39.9351673)", "POINT(116.3249438 39.9083473)")
    assert sql(f"SELECT s2_hex_to_cell(s2_cell_to_hex({cell})) = {cell}")[0][0]
    assert sql("SELECT s2_cell_id_from_point('POINT(116.4 39.9)') > 0")[0][0]


def test_generators(sql):
    assert sql(f"SELECT count(*) FROM s2_covering({BEIJING}, 8, 10)") == [(57,)]
    assert sql(f"SELECT count(*) FROM s2_interior_covering({BEIJING}, 8, 10, 64)") == [(24,)]
    assert sql("SELECT count(*) FROM s2_covering('x', 8, 10)") == [(0,)]
    one = f"(SELECT s2_cell_id({HERE}, {COARSE}) AS c)"
    assert sql(f"SELECT count(*) FROM {one}, LATERAL s2_children(c, {published.CHILD_LEVEL})") == [(published.CHILDREN,)]
    assert sql(f"SELECT count(*) FROM {one}, LATERAL s2_children(c, 7)") == [(0,)]
    assert sorted(sql(f"SELECT neighbor_id FROM {one}, LATERAL s2_cell_neighbors(c)")) == sorted(
        [(3886659254978871296,), (3887081467443937280,), (3886870361211404288,), (3886729623723048960,)]
    )
    many = sql(f"SELECT k, count(*) FROM VALUES (1, {BEIJING}), (2, 'POINT(1 2)') t(k, w), LATERAL s2_covering(w, 3, 9) GROUP BY k")
    assert dict(many)[2] == 1


@pytest.mark.parametrize("level", range(10, 17))
def test_covering_as_the_operator(spark, sql, level):
    """Beyond 4096 forced cells too."""
    got = spark.sql(f"SELECT cell_id FROM s2_covering({BEIJING}, {level}, {level})")
    want = covering(spark.sql(f"SELECT {BEIJING} AS wkt"), "wkt", level, level).select("cell_id")
    sums = ("count(*)", "count(DISTINCT cell_id)", "sum(CAST(cell_id AS DECIMAL(38)))")
    assert got.selectExpr(*sums).first() == want.selectExpr(*sums).first()


def test_deep_children(sql):
    one = f"(SELECT s2_cell_id({HERE}, {COARSE}) AS c)"
    assert sql(f"SELECT count(*), count(DISTINCT child_id) FROM {one}, LATERAL s2_children(c, 18)") == [(4**10, 4**10)]


def test_names_give_what_the_staged_form_gives(spark, sql):
    points = spark.range(3000).selectExpr(
        "if(id % 97 = 0, NULL, CAST((id * 7919) % 18001 AS DOUBLE) / 100 - 90) AS lat",
        "CAST((id * 104729) % 36001 AS DOUBLE) / 100 - 180 AS lon", "CAST(id % 33 AS INT) - 1 AS level", "id",
    )
    calls = {
        "s2_cell_id": ("lat", "lon", "level"), "s2_contains": ("cell", "lat + (id % 3) / 50D", "lon"),
        "s2_distance_meters": ("cell", "other"), "s2_area_m2": ("cell", "level"), "s2_to_geo": ("cell",),
        "s2_cell_vertex": ("cell", "CAST(id % 6 AS INT) - 1"),
    }
    df = functions.s2_cell_id.add(points, "cell", "lat", "lon", "level")
    df = functions.s2_cell_id.add(df, "other", "lat / 2", "lon", 9).cache()
    df.createOrReplaceTempView("t")
    for name, args in calls.items():
        staged = getattr(functions, name).add(df, "out", *args).select("id", "out").collect()
        named = spark.sql(f"SELECT id, {name}({', '.join(args)}) AS out FROM t").collect()
        for a, b in zip(sorted(staged), sorted(named), strict=True):
            assert a.id == b.id and (a.out is None) == (b.out is None), (name, a, b)
            if isinstance(a.out, float):
                assert b.out == pytest.approx(a.out, rel=1e-9, abs=1e-6), (name, a, b)
            elif isinstance(a.out, str) and a.out:
                near = [[float(x) for x in r.out[6:-1].split()] for r in (a, b)]
                assert near[1] == pytest.approx(near[0], abs=2e-7), (name, a, b)
            else:
                assert a.out == b.out, (name, a, b)


def test_unions(sql):
    rows = sql(
        "WITH cu AS (SELECT s2_cell_union_pack(string_agg(s2_cell_to_hex(cid), ',')) AS b FROM "
        "(SELECT s2_cell_id(lat, lon, 8) AS cid FROM VALUES (39.9D, 116.4D), (40.0D, 117.0D) p(lat, lon))) "
        "SELECT s2_cell_union_area(b), s2_cell_union_contains(b, s2_cell_id(39.9, 116.4, 10)), "
        "s2_cell_union_intersects(b, s2_cell_union_pack('1')), octet_length(b) FROM cu"
    )
    assert rows[0][0] == pytest.approx(2186890665.635735) and rows[0][1:] == (True, False, 20)


def test_rasters(spark, sql, tmp_path):
    data = np.arange(24, dtype="f4").reshape(3, 4, 2)
    path = write_tiff(tmp_path / "a.tif", data, tie=(100, 50), scale=(0.5, 0.25), nodata="-1", keys=[(2048, 4326)])
    register_rasters(
        spark, read_geotiff(spark, path, "metadata", maxTilePixels=4), read_geotiff(spark, path, maxTilePixels=4)
    )
    f = f"'{path}'"
    assert sql(f"SELECT rs_band_count({f}), rs_width({f}), rs_height({f}), rs_nodata({f}, 1), rs_geo_transform({f}), "
               f"rs_scale_x({f}), rs_scale_y({f}), rs_crs({f})")[0] == (
        2, 4, 3, -1.0, "100,0.5,0,50,0,-0.25", 0.5, 0.25, "EPSG:4326")
    assert sql("SELECT rs_width('q'), rs_crs('q'), rs_scale_x('q'), rs_min('q')")[0] == (0, "", 1.0, math.inf)
    values = sql(f"SELECT rs_value({f}, 1, 1, 2), rs_value({f}, 5, 3, 0), rs_value({f}, 1, -1, -1), rs_value({f}, 1, 4, 0)")[0]
    assert values[:3] == (18.0, 7.0, 0.0) and math.isnan(values[3])
    assert sql(f"SELECT rs_pixel_to_world({f}, 1, 1), rs_world_to_pixel({f}, 101, 49), rs_world_to_pixel('q', 1, 1)")[0] == (
        "POINT(100.5000000 49.7500000)", "POINT(2.000 4.000)", "POINT(NaN NaN)")
    assert sql(f"SELECT rs_min({f}), rs_max({f}), rs_mean({f})")[0] == (0.0, 22.0, 11.0)
    assert sql(f"SELECT * FROM rs_metadata({f})") == [(path, 4, 3, 2, "EPSG:4326")]
    assert sql(f"SELECT min, max, mean, count FROM rs_stats({f}, 2)") == [(1.0, 23.0, 12.0, 12)]
    assert sql(f"SELECT min FROM rs_stats({f}, 9)") == [(1.0,)]
    assert sorted(sql(f"SELECT * FROM rs_histogram({f}, 1, 2)")) == [(5.5, 6), (16.5, 5)]
    assert sql("SELECT path, rs_value(path, 1, 2, 0) FROM raster_metadata") == [(path, 4.0)]


@pytest.fixture
def opened(tmp_path):
    """Names of the files that any process opens as rasters."""
    log, whole = tmp_path / "opened.txt", Tiff.__init__

    def noted(self, path, max_pixels=1 << 18, _whole=whole, _log=str(log)):
        with open(_log, "a") as f:
            f.write(f"{path}\n")
        _whole(self, path, max_pixels)

    Tiff.__init__ = noted
    yield lambda: log.read_text().split() if log.exists() else []
    Tiff.__init__ = whole


@pytest.fixture
def files(tmp_path):
    rng = np.random.default_rng(7)
    data = [rng.normal(k, 3, (9 + k, 7, 2)).astype("f4") for k in range(4)]
    data[1][2:4, 1, 0] = np.nan
    data[2][...] = 5
    return [(write_tiff(tmp_path / f"{k}.tif", d, rows_per_strip=4, tie=(0, 0), scale=(1, 1)), d) for k, d in enumerate(data)]


def bins_by_definition(values, bins):
    """Half-open bins between the least and the largest number; a constant raster's and NaN samples are in the first."""
    low, high = np.nanmin(values), np.nanmax(values)
    width, counts = (high - low) / bins, [0] * bins
    for v in values.ravel():
        k = 0 if width == 0 or np.isnan(v) else math.floor((v - low) / width)
        if k < bins:
            counts[k] += 1
    return [(low + (k + 0.5) * width, n) for k, n in enumerate(counts)]


def test_table_functions_over_columns(spark, sql, files, opened):
    """Each request reads the file that it names: others are not opened, not even the registered ones."""
    register_rasters(spark, read_geotiff(spark, [p for p, _ in files], "metadata"), read_geotiff(spark, [p for p, _ in files]))
    asked = [(files[0][0], 1, 4), (files[0][0], 2, 3), (files[1][0], 1, 5), (files[1][0], 9, 1), (files[2][0], -4, 3), (None, 1, 2)]
    spark.createDataFrame(asked, "path string, band int, bins int").coalesce(1).createOrReplaceTempView("requests")
    arrays = dict(files)
    got = {}
    for path, band, bins, value, n in sql("SELECT r.*, h.* FROM requests r, LATERAL rs_histogram(path, band, bins) h"):
        got.setdefault((path, band, bins), []).append((value, n))
    assert sorted(opened()) == sorted(p for p, _ in files[:3])  # runs of one file open it once
    assert len(got) == 5
    for (path, band, bins), rows in got.items():
        want = bins_by_definition(arrays[path][..., min(max(band, 1), 2) - 1].astype(float), max(bins, 2))
        assert [n for _, n in rows] == [n for _, n in want]
        assert [v for v, _ in rows] == pytest.approx([v for v, _ in want])
    stats = sql("SELECT path, band, s.* FROM requests, LATERAL rs_stats(path, band) s")
    assert len(stats) == 5
    for path, band, low, high, mean, stddev, n in stats:
        values = arrays[path][..., min(max(band, 1), 2) - 1].astype(float)
        assert (low, high, n) == (np.nanmin(values), np.nanmax(values), values.size)
        assert (mean, stddev) == pytest.approx((values.mean(), values.std()), nan_ok=True)
    assert len(sql("SELECT m.* FROM requests, LATERAL rs_metadata(path) m")) == 5


def test_statistics_read_the_named_file_alone(spark, sql, files, opened):
    register_rasters(spark, read_geotiff(spark, [p for p, _ in files], "metadata"))
    (path, data), f = files[3], f"'{files[3][0]}'"
    low, high, mean, stddev = sql(f"SELECT rs_min({f}), rs_max({f}), rs_mean({f}), rs_stddev({f})")[0]
    band = data[..., 0].astype(float)
    assert (low, high) == (band.min(), band.max()) and (mean, stddev) == pytest.approx((band.mean(), band.std()))
    assert set(opened()) == {path}
    spark.createDataFrame([(files[0][0],), ("absent.tif",), (None,)], "path string").createOrReplaceTempView("asked")
    assert sql("SELECT rs_min(path), rs_max(path) FROM asked") == [
        (files[0][1][..., 0].min(), files[0][1][..., 0].max()), (math.inf, -math.inf), (math.inf, -math.inf)]
    one = sql(f"SELECT * FROM rs_histogram({f}, 1, 6)")
    assert one == [(pytest.approx(v), n) for v, n in bins_by_definition(band, 6)]


def test_an_absent_raster_is_an_error_of_a_table(spark, sql, files):
    register_rasters(spark, read_geotiff(spark, files[0][0], "metadata"))
    for call in ("rs_metadata('absent.tif')", "rs_stats('absent.tif', 1)", "rs_histogram('absent.tif', 1, 2)"):
        with pytest.raises(Exception, match="absent.tif"):
            sql(f"SELECT * FROM {call}")
