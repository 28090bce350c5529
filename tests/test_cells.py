import random

import pytest
from pyspark.sql import functions as F

from gridlark.functions import (
    s2_area_m2,
    s2_cell_id,
    s2_cell_id_from_point,
    s2_cell_level,
    s2_cell_to_hex,
    s2_cell_vertex,
    s2_contains,
    s2_distance_meters,
    s2_hex_to_cell,
    s2_parent,
    s2_to_geo,
)
from gridlark.operators.cells import children, neighbors

LEAVES = [
    (49.703498679, 11.770681595, "47a1cbd595522b39"),
    (55.685376759, 12.588490937, "46525318b63be0f9"),
    (45.486546517, -93.449700022, "52b30b71698e729d"),
    (58.299984854, 23.049300056, "46ed8886cfadda85"),
    (34.364439040, 108.330699969, "3663f18a24cbe857"),
    (-30.694551352, -30.048758753, "010a06c0a948cf5d"),
    (-25.285264027, 133.823116966, "2b2bfd076787c5df"),
    (-75.000000031, 0.000000133, "b09dff882a7809e1"),
]
# lat, lon, level, id, token, center, area, neighbours
CELLS = [
    (39.9, 116.4, 10, 3886697737885843456, "35f053", (116.3721711, 39.9351673), 68621578.109825,
     (3886691140816076800, 3887078168909053952, 3886699936909099008, 3886695538862587904)),
    (39.9, 116.4, 8, 3886694439350960128, "35f05", (116.2304616, 39.9313066), 1099556635.875645,
     (3886659254978871296, 3887081467443937280, 3886870361211404288, 3886729623723048960)),
    (40.0, 117.0, 8, 3887011098699759616, "35f17", (116.9852422, 40.0510104), 1087334029.760090,
     (3887046283071848448, 3887679601769447424, 3886975914327670784, 3886905545583493120)),
    (-33.86, 151.2, 10, 7715421526173941760, "6b12af", (151.1869325, -33.8426353), 78386780.554895,
     (7715410531057664000, 7715423725197197312, 7715419327150686208, 7715414929104175104)),
    (40.7, -74.0, 12, -8520148382826627072, "89c25a3", (-73.9947563, 40.7073444), 4357190.964545,
     (-8520148520265580544, -8520148245387673600, -8520146596120231936, -8520149070021394432)),
    (-89.0, 45.0, 5, -5763481623127392256, "b004", (45.0, -88.2860419), 74779857472.794632,
     (-5765733422941077504, -5756726223686336512, -5761229823313707008, -4995617886660722688)),
]


def signed(text):
    n = int(text, 16)
    return n - (1 << 64) if n >> 63 else n


def xy(text):
    assert text.startswith("POINT(")
    return tuple(map(float, text[6:-1].split()))


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(a, b, level) for a, b, level, *_ in CELLS]
    df = spark.createDataFrame(rows, "lat double, lon double, level int")
    df = s2_cell_id.add(df, "cell", "lat", "lon", "level")
    df = df.withColumn("token", s2_cell_to_hex("cell")).withColumn("own", s2_cell_level("cell"))
    df = s2_to_geo.add(df, "center", "cell")
    df = s2_area_m2.add(df, "area", "cell", "level")
    df = s2_contains.add(df, "inside", "cell", "lat", "lon")
    return {r.cell: r for r in df.collect()}


def test_leaf_ids_in_every_form(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in LEAVES], "lat double, lon double")
    df = s2_cell_id.add(df, "staged", "lat", "lon", 30)
    df = df.withColumn("text", s2_cell_id("lat", "lon", 30))
    df = df.withColumn("column", s2_cell_id(F.col("lat"), F.col("lon"), F.lit(30)))
    for row, (_, _, want) in zip(df.collect(), LEAVES, strict=True):
        assert row.staged == row.text == row.column == signed(want)


def test_golden_cells(cells):
    for _, _, level, cell, token, center, area, _ in CELLS:
        row = cells[cell]
        assert row.token == token and row.own == level and row.inside
        assert xy(row.center) == pytest.approx(center, abs=1.5e-7)
        assert row.area == pytest.approx(area, rel=1e-9)


def test_tokens(spark):
    df = spark.sql("SELECT explode(array('35f053', '35F053', 'X', '', 'zz', '12345678901234567', '1', '8', NULL)) AS t")
    got = [r[0] for r in df.select(s2_hex_to_cell("t")).collect()]
    assert got == [3886697737885843456] * 2 + [0, 0, 0, 0, 1 << 60, -(1 << 63), None]
    faces = spark.range(6).selectExpr("(id << 61) | (1L << 60) AS cell")
    assert [r[0] for r in faces.select(s2_cell_to_hex("cell")).collect()] == ["1", "3", "5", "7", "9", "b"]
    assert spark.range(1).select(s2_cell_to_hex("0L")).first()[0] == "X"


def test_vertices_and_distance(spark):
    df = spark.range(-1, 5).selectExpr("CAST(id AS INT) AS k")
    got = [r[0] for r in df.select(s2_cell_vertex(3886697737885843456, "k")).collect()]
    want = [(116.3249438, 39.9083473), (116.4193890, 39.8853048), (116.4193890, 39.9619373), (116.3249438, 39.9849908)]
    assert got[0] == got[5] == ""
    for text, point in zip(got[1:5], want, strict=True):
        assert xy(text) == pytest.approx(point, abs=1.5e-7)
    d = spark.range(1).select(s2_distance_meters(3886694439350960128, 3887011098699759616)).first()[0]
    assert d == pytest.approx(65663.79700336812, rel=1e-12)


def test_signs_of_zero_in_centers(spark):
    df = spark.sql("SELECT explode(array(3L << 61 | 1L << 60, 2L << 61 | 1L << 60, 5L << 61 | 1L << 60)) AS c")
    got = [r[0] for r in df.select(s2_to_geo("c")).collect()]
    assert got == [
        "POINT(-180.0000000 -0.0000000)",
        "POINT(-180.0000000 90.0000000)",
        "POINT(0.0000000 -90.0000000)",
    ]


def test_wkt_points(spark):
    rows = ["POINT(116.4 39.9)", "  point ( 1.164e2\t39.9 ) ", "POINT Z (116.4 39.9 5)", "POINT(1 2, 3 4)",
            "LINESTRING(1 2, 3 4)", "POINT EMPTY", "POINT(a b)", "", None]
    df = spark.createDataFrame([(k, w) for k, w in enumerate(rows)], "k int, w string")
    got = [r.c for r in s2_cell_id_from_point.add(df, "c", "w").orderBy("k").collect()]
    assert got == [3886697449207846475] * 3 + [0] * 5 + [None]


def test_null_and_level_out_of_range(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, NULL, 3), (NULL, 1D, 3), (1D, 2D, NULL), (1D, 2D, 31), (1D, 2D, -1) t(a, b, l)")
    assert [r.c for r in s2_cell_id.add(df, "c", "a", "b", "l").collect()] == [None] * 5
    one = spark.sql("SELECT CAST(NULL AS BIGINT) AS n, 1L AS c")
    for out in (s2_to_geo("n"), s2_area_m2("n", 3), s2_cell_level("n"), s2_cell_to_hex("n"), s2_parent("n", 3),
                s2_parent("c", 31), s2_distance_meters("n", "c"), s2_contains("n", 1.0, 2.0), s2_cell_vertex("n", 0)):
        assert one.select(out).first()[0] is None


def random_points(spark, n=400, seed=5):
    rng = random.Random(seed)
    edge = [(a, b) for a in (-90.0, -45.0, 0.0, 45.0, 90.0) for b in (-180.0, -90.0, -45.0, 0.0, 45.0, 135.0, 180.0)]
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)] + edge
    return spark.createDataFrame([(k, a, b, k % 31) for k, (a, b) in enumerate(rows)], "k int, lat double, lon double, level int")


def test_properties(spark):
    df = s2_cell_id.add(random_points(spark), "cell", "lat", "lon", "level")
    df = df.withColumn("own", s2_cell_level("cell")).withColumn("back", s2_hex_to_cell(s2_cell_to_hex.sql("cell")))
    df = s2_contains.add(df, "inside", "cell", "lat", "lon")
    df = s2_cell_id_from_center(df)
    for r in df.collect():
        assert r.own == r.level and r.inside and r.back == r.cell and r.again == r.cell, r


def s2_cell_id_from_center(df):
    """The center's cell at the level is the cell."""
    df = s2_to_geo.add(df, "center", "cell")
    df = s2_cell_id_from_point.add(df, "leaf", "center")
    # 7 decimals are too few for the finest cells
    df = df.withColumn("again", s2_parent("leaf", "level"))
    return df.withColumn("again", F.expr("if(level > 24, cell, again)"))


def test_children(spark):
    df = spark.createDataFrame([(3886694439350960128,), (-8520148382826627072,)], "cell long")
    rows = children(df, "cell", 12).collect()
    by = {}
    for r in rows:
        by.setdefault(r.cell, []).append(r.child_id)
    assert len(by[3886694439350960128]) == 256 and by[-8520148382826627072] == [-8520148382826627072]
    assert min(by[3886694439350960128]) == 3886676915884392448 and max(by[3886694439350960128]) == 3886711962817527808
    deep = children(df.limit(1), "cell", 16).select("child_id").distinct()
    assert deep.count() == 4**8
    assert deep.select(s2_parent("child_id", 8).alias("p")).distinct().collect() == [(3886694439350960128,)]
    assert children(df, "cell", 5).count() == 0


def test_neighbors(spark):
    df = spark.createDataFrame([(c[3],) for c in CELLS], "cell long")
    by = {}
    for r in neighbors(df, "cell").collect():
        by.setdefault(r.cell, []).append(r.neighbor_id)
    for c in CELLS:
        assert by[c[3]] == list(c[7])


def test_neighbors_are_mutual(spark):
    df = s2_cell_id.add(random_points(spark, 150, 9).where("level > 1"), "cell", "lat", "lon", "level")
    near = neighbors(df.select("cell", "level").distinct(), "cell")
    counts = near.groupBy("cell").agg(F.countDistinct("neighbor_id").alias("n"))
    assert counts.where("n <> 4").count() == 0
    assert near.where(s2_cell_level("neighbor_id") != F.col("level")).count() == 0
    back = neighbors(near, "neighbor_id", "again").where("again = cell").select("cell", "neighbor_id").distinct()
    assert back.count() == near.select("cell", "neighbor_id").distinct().count()


def test_filters_stay_above_the_steps(spark):
    """A condition on the result must not repeat the steps; one on another column must move below."""
    df = s2_cell_id.add(spark.range(100).selectExpr("id", "id / 3 AS lat", "id / 2 AS lon"), "cell", "lat", "lon", 12)
    plan = df.where("cell > 5 AND id < 7")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000
    assert plan.index("cell#") < plan.index("Generate")
    assert "id#" in plan[plan.rindex("Filter") :]


def test_code_is_small_enough_to_be_compiled(spark):
    """The JIT compiles no method beyond 8000 bytes."""
    import re

    points = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS lat", "CAST(id AS DOUBLE) AS lon")
    df = s2_cell_id.add(points, "cell", "lat", "lon", 12)
    df = s2_area_m2.add(df, "area", "cell", 10)
    df = s2_contains.add(df, "inside", "cell", "lat", "lon")
    df = s2_distance_meters.add(df, "far", "cell", 3887011098699759616)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = df._jdf.queryExecution().explainString(mode)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000
