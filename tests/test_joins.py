import random

import pytest
from pyspark.sql import functions as F

from gridlark.functions import s2_cell_id
from gridlark.operators import sweep
from gridlark.operators.cells import neighbors
from gridlark.operators.joins import (
    cell_density,
    neighbor_join,
    points_in_cells,
    points_in_fences,
    union_overlap_join,
)

# broadcast, and the shuffled join with split partitions
WAYS = [
    {},
    {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    },
]


@pytest.fixture(autouse=True)
def settings(spark, request):
    way = request.node.callspec.params.get("way", {}) if hasattr(request.node, "callspec") else {}
    for name, value in way.items():
        spark.conf.set(name, value)
    yield
    for name in way:
        spark.conf.unset(name)


def span(c):
    return c - ((c & -c) - 1), c + ((c & -c) - 1)


@pytest.fixture(scope="module")
def points(spark):
    """A third of the points in one place."""
    rng = random.Random(8)
    rows = [(k, 39.5 + rng.random() / 50, 116.5 + rng.random() / 50) if k % 3 == 0
            else (k, rng.uniform(-80, 80), rng.uniform(-179, 179)) for k in range(600)]
    rows.append((600, None, 1.0))
    return spark.createDataFrame(rows, "id int, lat double, lon double").cache()


@pytest.fixture(scope="module")
def leaves(points):
    return {r.id: r.leaf for r in s2_cell_id.add(points, "leaf", "lat", "lon", 30).collect() if r.leaf}


@pytest.mark.parametrize("way", WAYS)
def test_points_in_cells(spark, points, leaves, way):
    table = s2_cell_id.add(points.where("id % 2 = 0").withColumn("l", F.expr("id % 9")), "cell_id", "lat", "lon", "l")
    table = table.where("cell_id IS NOT NULL").selectExpr("id AS owner", "cell_id").cache()
    got = points_in_cells(points, table, "lat", "lon").select("id", "owner").collect()
    cells = table.collect()
    want = [(k, c.owner) for k, leaf in leaves.items() for c in cells if span(c.cell_id)[0] <= leaf <= span(c.cell_id)[1]]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("way", WAYS)
def test_points_in_fences(spark, points, way):
    rng = random.Random(3)
    boxes = [(39.4, 116.2, 0.5, 0.7), (-90.0, -180.0, 180.0, 360.0)]
    boxes += [(rng.uniform(-80, 60), rng.uniform(-179, 140), rng.uniform(0, 20), rng.uniform(0, 38)) for _ in range(20)]
    rows = [(k, f"LINESTRING({x!r} {y!r}, {x + w!r} {y + h!r})") for k, (y, x, h, w) in enumerate(boxes)]
    fences = spark.createDataFrame(rows, "fence int, wkt string")
    got = points_in_fences(points, fences, "fence", "wkt", "lat", "lon", 0, 10)
    want = [(p.id, k) for p in points.collect() if p.lat is not None for k, (y, x, h, w) in enumerate(boxes)
            if y <= p.lat <= y + h and x <= p.lon <= x + w]
    assert sorted((r.id, r.fence) for r in got.collect()) == sorted(want)


def nested(seed, n):
    """Cells of all levels around few places, so that they nest deeply; some twice."""
    rng = random.Random(seed)
    leaves = [rng.getrandbits(60) | 1 | rng.randrange(6) << 61 for _ in range(8)]
    out = []
    for _ in range(n):
        bit = 1 << (2 * rng.randrange(31))
        near = rng.choice(leaves) ^ (rng.getrandbits(60) >> rng.randrange(60) << 1)
        out.append((near & -bit & (1 << 64) - 1) | bit)
    return [c - (1 << 64) if c >> 63 else c for c in out if c >> 61 < 6]


@pytest.mark.parametrize(("ranges", "batch"), [(1, 10_000), (7, 10_000), (40, 3)])
def test_sweep_against_all_pairs(spark, ranges, batch):
    """Also over batches of a few rows, with a place that fills several ranges, and ids that are no cells."""
    rng = random.Random(ranges)
    cells = nested(3, 400) + [0, 2, -1, -(1 << 63), (7 << 61 | 1) - (1 << 64)]
    ends = [x for c in cells[:200] for x in span(c)]
    leaves = [max(rng.choice(ends) + rng.choice([0, 0, 2, -2]), -(1 << 63)) for _ in range(500)] + [ends[7]] * 300 + [None, None]
    points = spark.createDataFrame([(k, leaf, "x", leaf) for k, leaf in enumerate(leaves)], "id int, leaf long, cell string, _row long")
    table = spark.createDataFrame([(c,) for c in [*cells, *cells[:50], None]], "cell long").repartition(3)
    set_ = {"spark.sql.shuffle.partitions": ranges, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    before = {k: spark.conf.get(k) for k in set_}
    for k, v in set_.items():
        spark.conf.set(k, str(v))
    try:
        got = sweep.holding_cells(points.repartition(4), "leaf", points, table, "cell", "cell").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    good = {c for c in cells if c and (c & -c) & 0x5555555555555555 and (c >> 61) % 8 < 6}
    want = sorted((k, c) for k, leaf in enumerate(leaves) if leaf is not None for c in good if span(c)[0] <= leaf <= span(c)[1])
    assert sorted((r.id, r.cell) for r in got) == want and len(want) > 1000
    assert all(r._row == leaves[r.id] for r in got)


def test_a_frequent_place_is_spread(spark):
    """A place that fills several ranges is a bound several times, and its rows go to all of them."""
    points = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 1001L, id * 64 + 1) AS leaf")
    bounds = sweep.bounds_of(points, "leaf", 10)
    assert len(bounds) == 9 and bounds.count(1001) >= 3
    assert sweep.bounds_of(points.where("false"), "leaf", 10) == [] == sweep.bounds_of(points, "leaf", 1)


def test_points_move_once_to_find_their_cells(spark, points):
    """No row of a point is copied before the sweep, whatever the levels."""
    table = spark.createDataFrame([(k, c) for k, c in enumerate(nested(5, 60))], "owner int, cell_id long")
    plan = points_in_cells(points, table, "lat", "lon")._jdf.queryExecution().optimizedPlan().toString()
    joined, side = plan.split("MapInArrow")
    assert "Generate" not in joined and "Join Inner" in joined
    own = side.split("Union")[1].split("_cell")[0]
    assert "array(0, 3" not in side and "posexplode" not in own


@pytest.mark.parametrize("left", [True, False])
def test_empty_sides(spark, points, left):
    table = spark.createDataFrame([(1, 1 << 60)], "owner int, cell_id long")
    if left:
        assert points_in_cells(points.where("false"), table, "lat", "lon").count() == 0
    else:
        assert points_in_cells(points, table.where("false"), "lat", "lon").count() == 0


@pytest.mark.parametrize("way", WAYS)
def test_neighbor_join(spark, points, way):
    cells = s2_cell_id.add(points, "cell", "lat", "lon", 3).where("cell IS NOT NULL").select("id", "cell")
    other = cells.where("id % 5 = 0").selectExpr("id AS other", "cell AS near")
    near = {}
    for r in neighbors(cells.select("cell").distinct(), "cell").collect():
        near.setdefault(r.cell, set()).add(r.neighbor_id)
    a, b = cells.collect(), other.collect()
    want = sorted((x.id, y.other) for x in a for y in b if y.near in near[x.cell])
    got = neighbor_join(cells, other, "cell", "near").select("id", "other").collect()
    assert sorted(map(tuple, got)) == want
    semi = neighbor_join(cells, other, "cell", "near", "left_semi").collect()
    assert sorted(r.id for r in semi) == sorted({k for k, _ in want})


@pytest.mark.parametrize("way", WAYS)
def test_union_overlap_join(spark, points, way):
    def side(key, seed, levels):
        df = points.selectExpr(f"(id * {seed}) % 40 AS {key}", "lat", "lon", f"CAST({levels} AS INT) AS l")
        return s2_cell_id.add(df, "cell_id", "lat", "lon", "l").select(key, "cell_id").cache()

    left, right = side("a", 7, "2 + id % 4"), side("b", 11, "1 + id % 7")
    want = {(x.a, y.b) for x in left.collect() for y in right.collect() if x.cell_id and y.cell_id
            and span(x.cell_id)[0] <= span(y.cell_id)[1] and span(y.cell_id)[0] <= span(x.cell_id)[1]}
    got = union_overlap_join(left, right, "a", "b").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_density(points, leaves):
    got = {(r.level, r.cell_id): r.n for r in cell_density(points, "lat", "lon", [2, 5]).collect()}
    want = {}
    for leaf in leaves.values():
        for level in (2, 5):
            bit = 1 << (2 * (30 - level))
            key = (level, (leaf & -bit) | bit)
            want[key] = want.get(key, 0) + 1
    assert got == want
    assert {r.cell_id: r.n for r in cell_density(points, "lat", "lon", 5).collect()} == {
        c: n for (level, c), n in want.items() if level == 5
    }
