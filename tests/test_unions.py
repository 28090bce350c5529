import hashlib
import random
import struct
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridlark.functions import (
    s2_cell_level,
    s2_cell_union_area,
    s2_cell_union_contains,
    s2_cell_union_intersects,
    s2_cell_union_of,
    s2_cell_union_pack,
    s2_cell_union_unpack,
)
from gridlark.operators.cells import children
from gridlark.operators import segments, unions
from gridlark.operators.unions import (
    cell_union_agg,
    cell_union_area,
    cell_union_counts,
    cell_union_normalize,
    explode_union,
)

BLOB = "02000000000000000050f035000000000070f135"


def blob(ids):
    return bytearray(struct.pack(f"<I{len(ids)}q", len(ids), *ids))


def test_pack(spark):
    df = spark.createDataFrame(
        [(0, "35f05,35f17"), (1, " 3 ,, 1,1\t,zz"), (2, ""), (3, None), (4, " , ")], "k int, csv string"
    )
    got = {r.k: r.b for r in s2_cell_union_pack.add(df, "b", "csv").collect()}
    assert got[0].hex() == BLOB
    assert got[1] == blob([3 << 60, 1 << 60, 1 << 60, 0])  # order and copies kept, bad tokens are 0
    assert got[2] == got[4] == blob([]) and got[3] is None


def test_unpack(spark):
    ids = [5, -(1 << 62) + 1, 1 << 60]
    cases = [blob(ids), blob(ids)[:-1], blob(ids)[:3], bytearray(), blob([])[:4], blob(ids) + b"xx", None]
    df = spark.createDataFrame(list(enumerate(cases)), "k int, b binary")
    got = [r.u for r in df.withColumn("u", s2_cell_union_unpack("b")).orderBy("k").collect()]
    assert got == [ids, ids[:2], [], [], [], ids, None]
    same = df.where("k = 0").select(s2_cell_union_of(F.expr(s2_cell_union_unpack.sql("b")))).first()[0]
    assert same == blob(ids)


def test_contains_intersects_area(spark):
    df = spark.sql(f"SELECT unhex('{BLOB}') AS b")
    row = df.select(
        s2_cell_union_contains("b", 3886697737885843456).alias("child"),
        s2_cell_union_contains("b", 3886694439350960128).alias("self"),
        s2_cell_union_contains("b", (3886694439350960128 & -(1 << 46)) | 1 << 46).alias("parent"),
        s2_cell_union_area("b").alias("area"),
    ).first()
    assert row.child and row.self and not row.parent
    assert row.area == pytest.approx(2186890665.635735, rel=1e-9)


def test_intersects_is_symmetric_and_follows_ranges(spark):
    rng = random.Random(2)
    rows = []
    for k in range(60):
        pair = []
        for _ in range(2):
            ids = []
            for _ in range(rng.randrange(4)):
                level = rng.randrange(4)
                bit = 1 << (60 - 2 * level)
                n = rng.randrange(6 * 4**level) * 2 * bit + bit
                ids.append(n - (1 << 64) if n >> 63 else n)
            pair.append(ids)
        rows.append((k, *pair))

    def span(c):
        return c - ((c & -c) - 1), c + ((c & -c) - 1)

    df = spark.createDataFrame([(k, blob(a), blob(b)) for k, a, b in rows], "k int, a binary, b binary")
    df = df.withColumn("ab", s2_cell_union_intersects("a", "b")).withColumn("ba", s2_cell_union_intersects("b", "a"))
    for r, (_, a, b) in zip(df.orderBy("k").collect(), rows, strict=True):
        want = any(span(x)[0] <= span(y)[1] and span(y)[0] <= span(x)[1] for x in a for y in b)
        assert r.ab == r.ba == want


@pytest.fixture(scope="module")
def grouped(spark):
    # a third of all rows in one group, half of those copies of one cell
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('g', id % 7)) AS g",
        "if(id % 6 = 0, 5L << 58, ((id * 37) % 96 << 59) | (1L << 58)) AS cell",
    )
    return df.unionByName(spark.sql("SELECT 'none' AS g, CAST(NULL AS BIGINT) AS cell")), df


def test_union_agg(grouped):
    df, plain = grouped
    rows = cell_union_agg(df, ["g"], "cell").collect()
    want = {}
    for r in plain.collect():
        want.setdefault(r.g, []).append(r.cell)
    assert len(rows) == len(want)
    for r in rows:
        ids = list(struct.unpack(f"<{len(r.cells) // 8}q", bytes(r.cells)[4:]))
        assert struct.unpack("<I", bytes(r.cells)[:4])[0] == len(ids)
        assert ids == sorted(want[r.g], key=lambda c: c % (1 << 64))
    counts = cell_union_counts(df, ["g"], "cell").collect()
    assert {(r.g, r.cell): r.n for r in counts} == Counter((g, c) for g, ids in want.items() for c in ids)


def test_union_too_large_raises(grouped, monkeypatch):
    monkeypatch.setattr(unions, "MOST_CELLS", 200)
    with pytest.raises(Exception, match="cell_union_counts"):
        cell_union_agg(grouped[1], ["g"], "cell").collect()


def test_union_agg_without_groups(spark, grouped):
    whole = cell_union_agg(grouped[1], [], "cell").collect()
    assert len(whole) == 1 and len(whole[0].cells) == 4 + 8 * 3000
    assert hashlib.md5(bytes(whole[0].cells)).hexdigest()


def test_union_area_table(spark):
    df = spark.sql(f"SELECT 1 AS k, unhex('{BLOB}') AS b UNION ALL SELECT 2, unhex('00000000') UNION ALL SELECT 3, NULL")
    got = {r.k: r.area_m2 for r in cell_union_area(df, ["k"], "b").collect()}
    assert got[1] == pytest.approx(2186890665.635735, rel=1e-9) and got[2] == 0 and got[3] is None
    assert explode_union(df, "b").count() == 2


def test_normalize(spark):
    one = spark.createDataFrame([(3886694439350960128,)], "c long")
    kids = [r.k for r in children(one, "c", 10, "k").collect()]
    cases = [kids, kids[:3] + [kids[0]], kids[4:8] + [3886694439350960128], [], None]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, ids array<bigint>")
    got = [r.n for r in df.withColumn("n", cell_union_normalize("ids")).orderBy("i").collect()]
    assert got == [[3886694439350960128], sorted(kids[:3]), [3886694439350960128], [], None]
    levels = spark.createDataFrame([(c,) for c in kids[:2]], "c long").select(s2_cell_level("c")).collect()
    assert [r[0] for r in levels] == [10, 10]


def span(c):
    bit = (c & -c) - 1
    return c - bit, c + bit


def groups_of_cells(seed):
    """Nested, repeated and mergeable cells in two groups, one of them null; ids that are none."""
    rng, rows = random.Random(seed), []
    for g in ("a", None):
        for _ in range(40):
            level = rng.randrange(0, 9)
            bit = 1 << (2 * (30 - level))
            cell = (rng.randrange(3) << 61 | rng.getrandbits(8) << 53) & -bit | bit
            rows.append((g, cell))
            if level < 8 and rng.random() < 0.6:  # its children, perhaps theirs too
                kids = [cell + k * bit // 4 for k in (-3, -1, 1, 3)]
                rows += [(g, k) for k in kids] + [(g, kids[0] + k * bit // 16) for k in (-3, -1, 1, 3)]
        rows += [(g, None), (g, 0), (g, 2), (g, -(1 << 63))]
    return rows + rows[:30]


def plain_normal(cells):
    cells = {c for c in cells if c and c != -(1 << 63) and (c & -c) & 0x5555555555555555}
    cells = {c for c in cells if not any(c != d and span(d)[0] <= c <= span(d)[1] for d in cells)}
    merged = True
    while merged:
        merged = False
        for c in sorted(cells, key=lambda c: c & -c):
            bit = (c & -c) << 2
            kids = {((c & -bit) | bit) + k * bit // 4 for k in (-3, -1, 1, 3)}
            if bit <= 1 << 60 and kids <= cells:
                cells = cells - kids | {(c & -bit) | bit}
                merged = True
                break
    return cells


@pytest.mark.parametrize("level", [0, 3, 12])
def test_normal_form_as_rows(spark, level):
    rows = groups_of_cells(level)
    df = spark.createDataFrame(rows, "g string, c long").repartition(3)
    got = segments.normalized(df, ["g"], "c", level).collect()
    want = [(g, c) for g in ("a", None) for c in plain_normal([x for h, x in rows if h == g])]
    assert Counter((r.g, r.c) for r in got) == Counter(want)
    assert len(want) < len({c for _, c in rows})


def test_normal_form_of_whole_faces_and_of_nothing(spark):
    df = spark.createDataFrame([(1, (1 << 60) + k * (1 << 58)) for k in (-3, -1, 1, 3)], "g int, c long")
    assert [tuple(r) for r in segments.normalized(df, ["g"], "c").collect()] == [(1, 1 << 60)]
    assert segments.normalized(df.where("false"), ["g"], "c").count() == 0


@pytest.mark.parametrize("level", [0, 4])
def test_segments_answer_as_the_cells_do(spark, level):
    rows = groups_of_cells(7)
    df = spark.createDataFrame(rows, "g string, c long")
    parts = segments.cell_union_segments(df, ["g"], "c", level).cache()
    for r in parts.collect():
        assert r.ids == sorted(r.ids) and (r.first, r.last, r.n) == (r.ids[0], r.ids[-1], len(r.ids))
        assert all(span(a)[1] < span(b)[0] for a, b in zip(r.ids, r.ids[1:]))
    rng = random.Random(1)
    real = [c for _, c in rows if c and c > 2]
    asked = [(k, rng.choice(["a", None, "z"]), rng.choice(real) + rng.choice([0, 0, 2, -2, 1 << 40])) for k in range(300)] + [(300, "a", None)]
    got = segments.segments_contain(parts, spark.createDataFrame(asked, "id int, g string, c long"), ["g"], "c", "held", level).collect()
    cells = {g: [c for h, c in rows if h == g and c and c > 2] for g in ("a", None)}
    want = {k: None if c is None else any(span(d)[0] <= c <= span(d)[1] for d in cells.get(g, [])) for k, g, c in asked}
    assert {r.id: r.held for r in got} == want and {True, False, None} <= set(want.values())


def test_large_unions_meet_in_a_sweep(spark):
    """Two unions of 100 000 cells that alternate, and the same with one cell in common; nulls, empty and odd blobs."""
    even, odd = ([(1 << 60) | (k << 20) | (1 << 18) for k in range(a, 200_000, 2)] for a in (0, 1))
    cases = [(blob(even), blob(odd)), (blob(even), blob([*odd[:-1], even[77] + 2])), (blob(even), None), (blob([]), blob(even)),
             (blob([0, 1 << 60]), blob([0])), (blob([1 << 60]), blob([even[5]])), (blob([even[5]]), blob([1 << 60]))]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a binary, b binary").coalesce(1).cache()
    df.count()
    unions.add_union_intersects(df.where("k < 0"), "a", "b", "met").collect()
    start = time.perf_counter()
    got = {r.k: r.met for r in unions.add_union_intersects(df, "a", "b", "met").collect()}
    assert got == {0: False, 1: True, 2: None, 3: False, 4: False, 5: True, 6: True}
    assert time.perf_counter() - start < 10


def test_sweep_agrees_with_all_pairs_of_cells(spark):
    rng, rows = random.Random(4), []
    for k in range(300):
        sides = []
        for _ in range(2):
            bits = [1 << (2 * rng.randrange(20, 31)) for _ in range(rng.randrange(4))]
            sides.append([(rng.choice([1, 2, 5]) << 61 | rng.getrandbits(12) << 49) & -b & (1 << 64) - 1 | b for b in bits])
        rows.append((k, *([c - (1 << 64) if c >> 63 else c for c in side] for side in sides)))
    df = spark.createDataFrame([(k, blob(a), blob(b)) for k, a, b in rows], "k int, a binary, b binary").repartition(2)
    got = {r.k: r.met for r in unions.add_union_intersects(df, "a", "b", "met").collect()}
    want = {k: any(span(x)[0] <= span(y)[1] and span(y)[0] <= span(x)[1] for x in a for y in b) for k, a, b in rows}
    assert got == want and 20 < sum(want.values()) < 280
