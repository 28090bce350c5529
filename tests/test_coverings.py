import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from published import BEIJING
from pyspark.sql import functions as F

from gridlark.functions import s2_cell_id, s2_cell_level, wkt
from gridlark.operators import coverings, descent, rectcover
from gridlark.operators.coverings import covering, interior_covering


def boxes():
    rng = random.Random(11)
    special = [(86, 90, -180, 180), (-90, -85, -180, 180), (-2, 2, -180, -150), (43, 47, 40, 60), (-1, 1, -1, 1),
               (0, 0, 0, 0), (10, 10, 20, 25), (-60, 70, -170, 175), (89.9, 90, 10, 11)]
    out = list(special)
    for _ in range(40):
        lat, lon = rng.uniform(-88, 80), rng.uniform(-180, 165)
        out.append((lat, lat + rng.choice([0.01, 1, 4]) * rng.random(), lon, lon + rng.choice([0.05, 3, 12]) * rng.random()))
    return out


def text(box):
    a, b, c, d = box
    return f"POLYGON(({c!r} {a!r}, {d!r} {a!r}, {d!r} {b!r}, {c!r} {b!r}, {c!r} {a!r}))"


@pytest.fixture(scope="module")
def fences(spark):
    return spark.createDataFrame([(k, text(b), *map(float, b)) for k, b in enumerate(boxes())],
                                 "k int, wkt string, a double, b double, c double, d double").cache()


def spans(df, key):
    out = {}
    for r in df.collect():
        bit = r.cell_id & -r.cell_id
        out.setdefault(r[key], []).append((r.cell_id - (bit - 1), r.cell_id + (bit - 1)))
    return out


def inner_points(spark, n=60):
    rng = random.Random(4)
    rows = [(k, rng.uniform(a, b), rng.uniform(c, d)) for k, (a, b, c, d) in enumerate(boxes()) for _ in range(n)]
    df = spark.createDataFrame(rows, "k int, lat double, lon double")
    return s2_cell_id.add(df, "leaf", "lat", "lon", 30).collect()


@pytest.mark.parametrize(("low", "high"), [(0, 30), (2, 9), (0, 6)])
def test_covering_properties(spark, fences, low, high):
    found = covering(fences, "wkt", low, high).select("k", "cell_id").cache()
    by = spans(found, "k")
    assert set(by) == set(range(len(boxes())))
    for p in inner_points(spark):
        assert sum(a <= p.leaf <= b for a, b in by[p.k]) == 1, (p, boxes()[p.k])
    levels = found.select(F.min(s2_cell_level("cell_id")), F.max(s2_cell_level("cell_id"))).first()
    assert low <= levels[0] and levels[1] <= high
    for cells in by.values():
        assert len(cells) <= 64 or low > 0
        cells.sort()
        assert all(x[1] < y[0] for x, y in zip(cells, cells[1:], strict=False))


@pytest.mark.parametrize(("low", "high", "limit"), [(0, 12, 64), (3, 9, 20), (6, 10, 1)])
def test_interior_properties(spark, fences, low, high, limit):
    found = interior_covering(fences, "wkt", low, high, limit).select("k", "a", "b", "c", "d", "cell_id")
    inside = spans(found, "k")
    assert inside and all(len(v) <= max(limit, 4) or low > 0 for v in inside.values())
    # corners of the cells lie in the box
    squares = [(r, r.cell_id) for r in found.collect()]
    ids = np.array([c for _, c in squares])
    for k in range(4):
        df = spark.createDataFrame([(int(c),) for c in ids], "c long")
        from gridlark.functions import s2_cell_vertex

        points = df.select(s2_cell_vertex("c", k)).collect()
        for (r, _), p in zip(squares, points, strict=True):
            lon, lat = map(float, p[0][6:-1].split())
            assert r.a - 1e-6 <= lat <= r.b + 1e-6
            assert r.d - r.c >= 360 or any(r.c - 1e-6 <= lon + s <= r.d + 1e-6 for s in (-360, 0, 360)) or abs(lat) > 89.99
    for v in inside.values():
        v.sort()
        assert all(x[1] < y[0] for x, y in zip(v, v[1:], strict=False))


def test_counts_of_a_known_polygon(spark):
    df = spark.createDataFrame([(BEIJING,)], "wkt string")
    assert covering(df, "wkt", 8, 10).count() == 57
    assert interior_covering(df, "wkt", 8, 10, 64).count() == 24


def test_forced_cells_are_the_ones_that_meet_the_box(spark):
    """Beyond the in-task limit, cells are split by Spark; the result is that of the plain search."""
    df = spark.createDataFrame([(BEIJING,)], "wkt string")
    box = rectcover.Rects.of_degrees([39.0], [40.0], [116.0], [117.0])
    limit = rectcover.FORCED_LIMIT
    try:
        rectcover.FORCED_LIMIT = 1 << 30
        want = rectcover.cover(box, [13], [13], [64], False)[1]
    finally:
        rectcover.FORCED_LIMIT = limit
    got = covering(df, "wkt", 13, 13)
    assert got.count() == got.distinct().count()
    expanded = sum(4 ** (13 - int(30 - (int(c & -c).bit_length() - 1) // 2)) for c in want)
    assert got.count() == expanded > limit


@pytest.mark.parametrize(("low", "high", "limit", "interior"), [(0, 30, 64, False), (2, 9, 64, False), (0, 12, 64, True), (6, 10, 4, True)])
def test_steps_of_spark_give_what_one_search_gives(spark, low, high, limit, interior):
    """Cell by cell; repeated and null boxes too."""
    names = ("lat_lo", "lat_hi", "lon_lo", "lon_hi")
    rows = [(tuple(map(float, b)),) for b in boxes()]
    df = spark.createDataFrame([*rows, *rows[:9], (None,)], f"_box struct<{', '.join(n + ': double' for n in names)}>")
    got = sorted((tuple(r._box), r.cell) for r in descent.searched(df, low, high, limit, interior).collect())
    n = len(rows)
    rects = rectcover.Rects.of_degrees(*np.array([r[0] for r in rows]).T)
    owner, ids = rectcover.cover(rects, np.full(n, low), np.full(n, high), np.full(n, limit), interior)
    want = set()
    for k, c in zip(owner.tolist(), ids.tolist(), strict=True):
        bit = c & -c
        least = min(bit, 1 << 2 * (30 - low))
        want |= {(rows[k][0], x) for x in range(c - (bit - least), c + bit, 2 * least)}
    assert got == sorted(want)
    assert descent.searched(df.where("false"), low, high, limit, interior).count() == 0


def test_a_box_with_many_cells_is_no_group(spark, monkeypatch):
    """Beyond the budget every cell is a group of its own: no window holds the box's cells."""
    seen, real = [], descent._round

    def look(state, level, lo, *args):
        if level >= lo:
            most = state.groupBy("_g", "_key").count().agg(F.max("count")).first()[0]
            seen.append((level, most, state.count()))
        return real(state, level, lo, *args)

    monkeypatch.setattr(descent, "_round", look)
    monkeypatch.setattr(descent, "ROUNDS", 1)
    df = spark.createDataFrame([((39.0, 40.0, 116.0, 117.0),)], "_box struct<lat_lo: double, lat_hi: double, lon_lo: double, lon_hi: double>")
    found = descent.searched(df, 11, 13, 64, False)
    assert [x[:2] for x in seen] == [(11, 1), (12, 1)] and seen[0][2] > 500
    assert found.count() == found.distinct().count() == seen[0][2]


def test_text_that_is_no_geometry(spark):
    rows = ["", "POINT EMPTY", "POLYGON((1 2, 3))", "nonsense", "POINT(1 2, 3 4)", "LINESTRING(1 2, 3 4", None]
    df = spark.createDataFrame([(w,) for w in rows], "wkt string")
    assert covering(df, "wkt", 0, 5).count() == 0
    good = ["POINT(1 2)", "multipoint((1 2), (3 4))", "LINESTRING Z (1 2 3, 4 5 6)", "GEOMETRYCOLLECTION(POINT(1 2), LINESTRING(3 4, 5 6))",
            "MULTIPOLYGON(((1 2, 3 4, 5 1, 1 2)), ((7 8, 9 9, 8 7, 7 8)))"]
    df = spark.createDataFrame([(w,) for w in good], "wkt string")
    assert covering(df, "wkt", 0, 5).select("wkt").distinct().count() == len(good)


def test_nested_collections(spark):
    inner = "GEOMETRYCOLLECTION(POINT(5 6), GEOMETRYCOLLECTION Z (LINESTRING(1 2, 3 4)))"
    rows = [f"GEOMETRYCOLLECTION({inner}, {inner}, POINT(9 9))", f"GEOMETRYCOLLECTION({inner}", "GEOMETRYCOLLECTION(GEOMETRYCOLLECTION())"]
    df = spark.createDataFrame([(w,) for w in rows], "wkt string").selectExpr(f"{wkt.bounds('wkt')} AS b")
    got = [r.b and tuple(r.b) for r in df.collect()]
    assert got == [(2, 9, 1, 9), None, None]


def test_too_deep_collections_are_an_error(spark):
    """Text beyond the nesting that is read must not pass for text that is no geometry."""
    deep = {k: "GEOMETRYCOLLECTION(" * k + "POINT(1 2)" + ")" * k for k in (8, 9, 12)}
    for k, w in deep.items():
        df = spark.createDataFrame([(w,), ("nonsense",)], "wkt string").selectExpr(f"{wkt.bounds('wkt')} AS b")
        if k == 8:
            assert [r.b and tuple(r.b) for r in df.collect()] == [(2, 2, 1, 1), None]
        else:
            with pytest.raises(Exception, match="nested more than 8 deep"):
                df.collect()


def test_searches_hold_a_bounded_number_of_cells():
    """A batch of boxes that are bound to many cells is cut; memory doesn't follow the batch."""
    rng = random.Random(1)
    corners = [(rng.uniform(-80, 70), rng.uniform(-170, 160)) for _ in range(300)]
    box = pa.StructArray.from_arrays(
        [pa.array(x) for x in zip(*((a, a + 3, b, b + 4) for a, b in corners))], list(coverings._BOX)
    )
    n, peaks = len(box), []
    for size in (100, 300):
        tracemalloc.start()
        args = (pa.array([v] * size) for v in (10, 10, 64))
        got = coverings._cover_batch(box.slice(0, size), *args, interior=False)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert len(got) == size and min(got.value_lengths().to_pylist()) > 20
    assert len(got) == n and peaks[1] < 1.8 * peaks[0] < 600e6


def test_interior_of_a_wide_box_at_a_deep_level():
    box = rectcover.Rects.of_degrees([-20.0], [20.0], [10.0], [70.0])
    start = time.perf_counter()
    owner, ids = rectcover.cover(box, [24], [24], [20], True)
    assert time.perf_counter() - start < 5 and 1 <= len(ids) <= 20
    assert set(owner.tolist()) == {0} and len(set(ids.tolist())) == len(ids)
