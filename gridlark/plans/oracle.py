"""SQL counterparts of the registered queries, for DuckDB on the same tables.

Written apart from the library: cells are encoded and decoded bit by bit with
list_reduce, and joins compare id ranges or coordinates directly.
"""

from __future__ import annotations

R = "6371009.0e0"
Ctes = list[tuple[str, str]]
TOP = 2305843009213693952  # 2^61


def _curve_tables() -> tuple[list[int], list[int]]:
    """One level: [orientation * 4 + 2i + j] -> position * 4 + new orientation, and back."""
    order = {0: [0, 1, 3, 2], 1: [0, 2, 3, 1], 2: [3, 2, 0, 1], 3: [3, 1, 0, 2]}
    turn = [1, 0, 0, 3]
    step = [order[o].index(ij) * 4 + (o ^ turn[order[o].index(ij)]) for o in range(4) for ij in range(4)]
    back = [order[o][pos] * 4 + (o ^ turn[pos]) for o in range(4) for pos in range(4)]
    return step, back


STEP, BACK = _curve_tables()


def sql(ctes: Ctes, select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes) + "\n" + select


def bit(level: str) -> str:
    return f"(1::BIGINT << (2 * (30 - ({level})))::BIGINT)"


def up(cell: str, level: str) -> str:
    return f"(({cell} & -{bit(level)}) | {bit(level)})"


def level_of(cell: str) -> str:
    return f"(30 - bit_count(({cell} & -{cell}) - 1) // 2)"


def low(cell: str) -> str:
    return f"({cell} - (({cell} & -{cell}) - 1))"


def high(cell: str) -> str:
    return f"({cell} + (({cell} & -{cell}) - 1))"


def token(cell: str) -> str:
    return f"rtrim(lpad(lower(to_hex({cell})), 16, '0'), '0')"


POINTS: Ctes = [
    (
        "points",
        "SELECT event_id AS id, CAST((event_id * 7919) % 16800 AS DOUBLE) / 100e0 - 84e0 + 0.00317e0 AS lat, "
        "CAST((event_id * 104729) % 35900 AS DOUBLE) / 100e0 - 179.5e0 + 0.00713e0 AS lon FROM events",
    )
]
PLACES: Ctes = [
    (
        "places",
        "SELECT c_custkey AS place, CAST((c_custkey * 6481) % 16700 AS DOUBLE) / 100e0 - 83e0 + 0.00271e0 AS lat, "
        "CAST((c_custkey * 92821) % 35800 AS DOUBLE) / 100e0 - 179e0 + 0.00519e0 AS lon FROM customer",
    )
]


def case(key: str, *values: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


def face_uv(src: str, p: str, x: str, y: str, z: str) -> Ctes:
    face = (
        f"CASE WHEN abs({x}) > abs({y}) THEN CASE WHEN abs({x}) > abs({z}) THEN 0 ELSE 2 END "
        f"WHEN abs({y}) > abs({z}) THEN 1 ELSE 2 END"
    )
    sign = case(f"{p}a", f"{x} < 0", f"{y} < 0", f"{z} < 0")
    u = case(f"{p}f", f"{y} / {x}", f"-{x} / {y}", f"-{x} / {z}", f"{z} / {x}", f"{z} / {y}", f"-{y} / {z}")
    v = case(f"{p}f", f"{z} / {x}", f"{z} / {y}", f"-{y} / {z}", f"{y} / {x}", f"-{x} / {y}", f"-{x} / {z}")
    return [
        (f"{p}_axis", f"SELECT *, {face} AS {p}a FROM {src}"),
        (f"{p}_face", f"SELECT *, {p}a + CASE WHEN {sign} THEN 3 ELSE 0 END AS {p}f FROM {p}_axis"),
        (f"{p}_uv", f"SELECT *, {u} AS {p}u, {v} AS {p}v FROM {p}_face"),
    ]


def encode(src: str, p: str, s: str, t: str) -> Ctes:
    """Column {p}leaf from face {p}f and square coordinates s, t in 0..1."""
    index = f"(acc & 3) * 4 + (({p}i >> k) & 1) * 2 + (({p}j >> k) & 1) + 1"
    return [
        (
            f"{p}_ij",
            f"SELECT *, least(floor(1073741824e0 * {s})::BIGINT, 1073741823) AS {p}i, "
            f"least(floor(1073741824e0 * {t})::BIGINT, 1073741823) AS {p}j FROM {src}",
        ),
        (
            f"{p}_pos",
            f"SELECT *, list_reduce(range(29, -1, -1), lambda acc, k: ((acc >> 2) << 4) | {STEP}[{index}], "
            f"({p}f & 1)::BIGINT) AS {p}acc FROM {p}_ij",
        ),
        (
            f"{p}_leaf",
            f"SELECT *, (CASE WHEN {p}f >= 4 THEN {p}f - 8 ELSE {p}f END)::BIGINT * {TOP} + ({p}acc >> 2) * 2 + 1 "
            f"AS {p}leaf FROM {p}_pos",
        ),
    ]


def leaf(src: str, p: str, lat: str = "lat", lon: str = "lon") -> Ctes:
    """Column {p}leaf of table {p}_leaf."""

    def st(u: str) -> str:
        return f"CASE WHEN {u} >= 0 THEN 0.5e0 * sqrt(1 + 3 * {u}) ELSE 1 - 0.5e0 * sqrt(1 - 3 * {u}) END"

    xyz = (
        f"SELECT *, cos(radians({lat})) * cos(radians({lon})) AS {p}x, "
        f"cos(radians({lat})) * sin(radians({lon})) AS {p}y, sin(radians({lat})) AS {p}z FROM {src}"
    )
    return [
        (f"{p}_xyz", xyz),
        *face_uv(f"{p}_xyz", p, f"{p}x", f"{p}y", f"{p}z"),
        (f"{p}_st", f"SELECT *, {st(f'{p}u')} AS {p}ss, {st(f'{p}v')} AS {p}tt FROM {p}_uv"),
        *encode(f"{p}_st", p, f"{p}ss", f"{p}tt"),
    ]


def decode(src: str, p: str, cell: str) -> Ctes:
    """Columns {p}f, {p}i, {p}j (low corner), {p}n (size) of table {p}_sq."""
    index = "(acc & 3) * 4 + ((%spos >> k) & 3) + 1" % p

    def bits(shift: int) -> str:
        return f"list_sum([(({p}m >> (2 * b + {2 + shift})::BIGINT) & 1) << b for b in range(30)])::BIGINT"

    return [
        (
            f"{p}_p",
            f"SELECT *, (({cell} >> 61) & 7)::BIGINT AS {p}f, ({cell} & {TOP - 1}) >> 1 AS {p}pos, "
            f"1::BIGINT << (30 - {level_of(cell)})::BIGINT AS {p}n FROM {src}",
        ),
        (
            f"{p}_m",
            f"SELECT *, list_reduce(range(58, -1, -2), lambda acc, k: ((acc >> 2) << 4) | {BACK}[{index}], "
            f"({p}f & 1)::BIGINT) AS {p}m FROM {p}_p",
        ),
        (f"{p}_b", f"SELECT *, {bits(1)} AS {p}i0, {bits(0)} AS {p}j0 FROM {p}_m"),
        (f"{p}_sq", f"SELECT *, {p}i0 - {p}i0 % {p}n AS {p}i, {p}j0 - {p}j0 % {p}n AS {p}j FROM {p}_b"),
    ]


def to_u(s: str) -> str:
    return (
        f"CASE WHEN {s} >= 0.5e0 THEN (1 / 3e0) * (4 * {s} * {s} - 1) "
        f"ELSE (1 / 3e0) * (1 - 4 * (1 - {s}) * (1 - {s})) END"
    )


def face_xyz(src: str, name: str, f: str, u: str, v: str, q: str) -> Ctes:
    """Unit vector columns {q}x, {q}y, {q}z of table {name}."""
    x = case(f, "1e0", f"-{u}", f"-{u}", "-1e0", v, v)
    y = case(f, u, "1e0", f"-{v}", f"-{v}", "-1e0", u)
    z = case(f, v, v, "1e0", f"-{u}", f"-{u}", "-1e0")
    norm = f"sqrt({q}x0 * {q}x0 + {q}y0 * {q}y0 + {q}z0 * {q}z0)"
    return [
        (f"{name}_raw", f"SELECT *, {x} AS {q}x0, {y} AS {q}y0, {z} AS {q}z0 FROM {src}"),
        (
            name,
            f"SELECT *, {q}x0 / {norm} AS {q}x, {q}y0 / {norm} AS {q}y, {q}z0 / {norm} AS {q}z FROM {name}_raw",
        ),
    ]


def center(src: str, p: str, cell: str) -> Ctes:
    """Unit vector {p}cx.. of a cell's center in table {p}_center."""
    return [
        *decode(src, p, cell),
        (
            f"{p}_cst",
            f"SELECT *, (2 * {p}i + {p}n) / 2147483648e0 AS {p}cs, (2 * {p}j + {p}n) / 2147483648e0 AS {p}ct FROM {p}_sq",
        ),
        (f"{p}_cuv", f"SELECT *, {to_u(f'{p}cs')} AS {p}cu, {to_u(f'{p}ct')} AS {p}cv FROM {p}_cst"),
        *face_xyz(f"{p}_cuv", f"{p}_center", f"{p}f", f"{p}cu", f"{p}cv", f"{p}c"),
    ]


def bounds(p: str) -> Ctes:
    """Columns {p}u0, {p}u1, {p}v0, {p}v1 in table {p}_bound, after decode."""
    parts = {
        "u0": f"({p}i / 1073741824e0)",
        "u1": f"(({p}i + {p}n) / 1073741824e0)",
        "v0": f"({p}j / 1073741824e0)",
        "v1": f"(({p}j + {p}n) / 1073741824e0)",
    }
    return [(f"{p}_bound", "SELECT *, " + ", ".join(f"{to_u(s)} AS {p}{n}" for n, s in parts.items()) + f" FROM {p}_sq")]


def geo(q: str) -> str:
    return (
        f"floor(degrees(atan2({q}y, {q}x)) * 1e5 + 0.125e0)::BIGINT AS point_lon, "
        f"floor(degrees(atan2({q}z, sqrt({q}x * {q}x + {q}y * {q}y))) * 1e5 + 0.125e0)::BIGINT AS point_lat"
    )


def area(p: str, cell: str) -> Ctes:
    """Steradians {p}area in table {p}_area for column ``cell`` of table {p}_src."""
    corners = [(f"{p}u0", f"{p}v0"), (f"{p}u1", f"{p}v0"), (f"{p}u1", f"{p}v1"), (f"{p}u0", f"{p}v1")]
    ctes = [*decode(f"{p}_src", p, cell), *bounds(p)]
    src = f"{p}_bound"
    for k, (u, v) in enumerate(corners):
        ctes += face_xyz(src, f"{p}_k{k}", f"{p}f", u, v, f"{p}k{k}")
        src = f"{p}_k{k}"

    def d(axis: str, a: int, b: int) -> str:
        return f"({p}k{b}{axis} - {p}k{a}{axis})"

    cross = " + ".join(
        f"power({d(a, 0, 2)} * {d(b, 1, 3)} - {d(b, 0, 2)} * {d(a, 1, 3)}, 2)" for a, b in ("yz", "zx", "xy")
    )
    value = (
        f"CASE WHEN {p}n >= 536870912 THEN 4 * pi() / 6 / power(4, 30 - bit_count({p}n - 1)) "
        f"ELSE {p}flat * 2 / (1 + sqrt(1 - least({p}flat / pi(), 1e0))) END"
    )
    return [
        *ctes,
        (f"{p}_flat", f"SELECT *, 0.5e0 * sqrt({cross}) AS {p}flat FROM {src}"),
        (f"{p}_area", f"SELECT *, {value} AS {p}area FROM {p}_flat"),
    ]


def cells(level: str = "id % 31") -> Ctes:
    """Points with their ``level`` and ``cell``: table ``tagged``."""
    return [
        *POINTS,
        *leaf("points", "a"),
        ("lv", f"SELECT id, lat, lon, aleaf AS leaf, CAST({level} AS INTEGER) AS level FROM a_leaf"),
        ("tagged", f"SELECT *, {up('leaf', 'level')} AS cell FROM lv"),
    ]


def neighbors(src: str, cell: str) -> Ctes:
    """Table ``near``: rows of ``src`` times the 4 neighbours, column neighbor_id."""
    span = "1.0000000000000002e0"

    def linear(n: str) -> str:
        return f"greatest(least((2 * least(greatest({n}, -1), 1073741824) + 1 - 1073741824) / 1073741824e0, {span}), -{span})"

    return [
        *decode(src, "n", cell),
        ("n_k", "SELECT *, unnest([0, 1, 2, 3]) AS k FROM n_sq"),
        (
            "n_t",
            "SELECT *, ni + CASE k WHEN 1 THEN nn WHEN 3 THEN -nn ELSE 0 END AS ti, "
            "nj + CASE k WHEN 2 THEN nn WHEN 0 THEN -nn ELSE 0 END AS tj FROM n_k",
        ),
        ("n_uv", f"SELECT *, {linear('ti')} AS tu, {linear('tj')} AS tv FROM n_t"),
        *face_xyz("n_uv", "n_w", "nf", "tu", "tv", "t"),
        *face_uv("n_w", "o", "tx0", "ty0", "tz0"),
        *encode("o_uv", "o", "(0.5e0 * (ou + 1))", "(0.5e0 * (ov + 1))"),
        ("near", f"SELECT *, {up('oleaf', level_of(cell))} AS neighbor_id FROM o_leaf"),
    ]


def little_endian(cell: str) -> str:
    h = f"lpad(lower(to_hex({cell})), 16, '0')"
    return "(" + " || ".join(f"substr({h}, {k}, 2)" for k in range(15, 0, -2)) + ")"


# Cells of the union built per event, and of a second position.
UNIONS: Ctes = [
    *cells("8"),
    *leaf("tagged", "e", "(-lat + 0.5e0)", "(lon / 2)"),
    ("two", f"SELECT id, cell, {up('eleaf', '6')} AS other FROM e_leaf"),
]

FENCES: Ctes = [
    (
        "fences",
        "SELECT s_suppkey AS fence, (s_suppkey * 53) % 300 - 150 AS x0, (s_suppkey * 37) % 140 - 70 AS y0 FROM supplier",
    ),
    (
        "boxes",
        "SELECT fence, CAST(x0 || '.0177' AS DOUBLE) AS lon_lo, CAST(x0 + 4 || '.0177' AS DOUBLE) AS lon_hi, "
        "CAST(y0 || '.0131' AS DOUBLE) AS lat_lo, CAST(y0 + 3 || '.0131' AS DOUBLE) AS lat_hi FROM fences",
    ),
    (
        "ordered",
        "SELECT fence, least(lon_lo, lon_hi) AS lon_lo, greatest(lon_lo, lon_hi) AS lon_hi, "
        "least(lat_lo, lat_hi) AS lat_lo, greatest(lat_lo, lat_hi) AS lat_hi FROM boxes",
    ),
]

LIST_LEVEL = 7


def _fence_cells(inside: bool) -> str:
    """All cells of a level with their corners, against the fences: a cell lies in a box with all its corners (its edges
    run between them in latitude and longitude), and meets it if a corner or its center is in the box, a corner of the
    box is in the cell, or an edge, part of a great circle, reaches a side of constant latitude between its ends."""
    level = bit(str(LIST_LEVEL))
    corners = [("pu0", "pv0"), ("pu1", "pv0"), ("pu1", "pv1"), ("pu0", "pv1")]
    ctes: Ctes = [
        *FENCES,
        (
            "all_cells",
            f"SELECT (CASE WHEN f >= 4 THEN f - 8 ELSE f END)::BIGINT * {TOP} + (2 * k + 1) * {level} AS cell "
            f"FROM range(6) a(f), range({4**LIST_LEVEL}) b(k)",
        ),
        *decode("all_cells", "p", "cell"),
        *bounds("p"),
    ]
    src = "p_bound"
    for k, (u, v) in enumerate(corners):
        ctes += face_xyz(src, f"corner{k}", "pf", u, v, f"k{k}")
        src = f"corner{k}"
    lat = [f"degrees(atan2(k{k}z, sqrt(k{k}x * k{k}x + k{k}y * k{k}y)))" for k in range(4)]
    lon = [f"degrees(atan2(k{k}y, k{k}x))" for k in range(4)]
    named = ", ".join([*(f"{t} AS lat{k}" for k, t in enumerate(lat)), *(f"{t} AS lon{k}" for k, t in enumerate(lon))])
    ctes.append(("placed", f"SELECT *, {named} FROM {src}"))
    low_lat, high_lat = "least(lat0, lat1, lat2, lat3)", "greatest(lat0, lat1, lat2, lat3)"
    low_lon, high_lon = "least(lon0, lon1, lon2, lon3)", "greatest(lon0, lon1, lon2, lon3)"
    if inside:
        return sql(
            ctes,
            f"SELECT fence, cell AS cell_id FROM placed JOIN ordered ON {low_lat} >= lat_lo AND {high_lat} <= lat_hi "
            f"AND {low_lon} >= lon_lo AND {high_lon} <= lon_hi",
        )
    ctes.append(
        (
            "near_",
            f"SELECT * FROM placed JOIN ordered ON {low_lat} - 0.1e0 <= lat_hi AND {high_lat} + 0.1e0 >= lat_lo "
            f"AND {low_lon} - 0.1e0 <= lon_hi AND {high_lon} + 0.1e0 >= lon_lo",
        )
    )
    corner_in = " OR ".join(f"(lat{k} BETWEEN lat_lo AND lat_hi AND lon{k} BETWEEN lon_lo AND lon_hi)" for k in range(4))
    ctes.append(("first_", f"SELECT *, {corner_in} AS hit FROM near_"))
    ctes.append(
        (
            "box_corners",
            "SELECT fence, cos(radians(la)) * cos(radians(lo)) AS x, cos(radians(la)) * sin(radians(lo)) AS y, "
            "sin(radians(la)) AS z FROM (SELECT fence, unnest([lat_lo, lat_lo, lat_hi, lat_hi]) AS la, "
            "unnest([lon_lo, lon_hi, lon_lo, lon_hi]) AS lo FROM ordered)",
        )
    )
    d = case("pf", "x", "y", "z", "-x", "-y", "-z")
    u = case("pf", "y", "-x", "-x", "-z", "-z", "y")
    v = case("pf", "z", "z", "-y", "-y", "x", "x")
    ctes.append(
        (
            "held",
            f"SELECT DISTINCT fence, cell FROM (SELECT fence, cell, pu0, pu1, pv0, pv1, {d} AS d, {u} AS u, {v} AS v "
            "FROM first_ JOIN box_corners USING (fence)) WHERE d > 0 AND u / d BETWEEN pu0 AND pu1 AND v / d BETWEEN pv0 AND pv1",
        )
    )
    # ends a and b of each edge, its plane's normal n, and the two points of that circle at the latitude of a side
    edges = " UNION ALL ".join(
        f"SELECT fence, cell, lon_lo, lon_hi, side, k{a}x AS ax, k{a}y AS ay, k{a}z AS az, k{b}x AS bx, k{b}y AS by_, k{b}z AS bz "
        "FROM (SELECT *, unnest([lat_lo, lat_hi]) AS side FROM first_ WHERE NOT hit)"
        for a, b in ((0, 1), (1, 2), (2, 3), (3, 0))
    )
    ctes += [
        ("edges", edges),
        ("planes", "SELECT *, ay * bz - az * by_ AS nx, az * bx - ax * bz AS ny, ax * by_ - ay * bx AS nz, sin(radians(side)) AS s FROM edges"),
        ("roots", "SELECT *, nx * nx + ny * ny AS h, (1 - s * s) - (nz * s) * (nz * s) / (nx * nx + ny * ny) AS r FROM planes"),
        (
            "crossings",
            "SELECT *, -nz * s * nx / h - g * ny * sqrt(r) / sqrt(h) AS x, -nz * s * ny / h + g * nx * sqrt(r) / sqrt(h) AS y "
            "FROM (SELECT *, unnest([-1, 1]) AS g FROM roots WHERE r >= 0)",
        ),
        (
            "reached",
            "SELECT DISTINCT fence, cell FROM crossings WHERE degrees(atan2(y, x)) BETWEEN lon_lo AND lon_hi "
            "AND (ay * s - az * y) * nx + (az * x - ax * s) * ny + (ax * y - ay * x) * nz >= 0 "
            "AND (y * bz - s * by_) * nx + (s * bx - x * bz) * ny + (x * by_ - y * bx) * nz >= 0",
        ),
    ]
    return sql(
        ctes,
        "SELECT fence, cell AS cell_id FROM first_ WHERE hit UNION SELECT fence, cell FROM held UNION SELECT fence, cell FROM reached",
    )


# -- rasters: derived from embeddings as the files are ------------------------------------
FILES: Ctes = [
    ("files", "SELECT vec_id // 64 AS n, count(*) AS height FROM embeddings GROUP BY 1"),
    (
        "meta",
        "SELECT n, 'r' || n || '.tif' AS file, 64 AS width, CAST(height AS INTEGER) AS height, 2 AS bands, "
        "10e0 * n + 0.5e0 AS gt0, 0.25e0 AS gt1, (60 - n)::DOUBLE AS gt3, -(0.5e0 + n % 3) AS gt5, "
        "CASE WHEN n % 2 = 0 THEN 'EPSG:4326' ELSE 'EPSG:' || (32600 + n % 60) END AS crs, "
        "CASE WHEN n % 2 = 0 THEN -9999e0 END AS nodata FROM files",
    ),
]
PIXELS: Ctes = [
    *FILES,
    (
        "vec",
        "SELECT vec_id // 64 AS n, vec_id % 64 AS r, label, unnest(embedding)::DOUBLE AS v, "
        "generate_subscripts(embedding, 1) - 1 AS c FROM embeddings",
    ),
    (
        "pixels",
        "SELECT n, 1 AS band, r, c, v AS value FROM vec UNION ALL "
        "SELECT n, 2 AS band, r, c, (label + c % 5)::DOUBLE AS value FROM vec",
    ),
]
REQUESTS: Ctes = [
    (
        "requests",
        "SELECT event_id AS id, event_id % ((SELECT max(vec_id) FROM embeddings) // 64 + 2) AS n, "
        "CAST(event_id % 4 AS INTEGER) AS band, CAST((event_id * 13) % 70 - 3 AS INTEGER) AS col, "
        "CAST((event_id * 7) % 70 - 3 AS INTEGER) AS rw FROM events",
    )
]


def header(value: str, missing: str, name: str) -> str:
    return sql(
        [*FILES, *REQUESTS],
        f"SELECT id, CASE WHEN m.n IS NULL THEN {missing} ELSE {value} END AS {name} "
        "FROM requests q LEFT JOIN meta m ON q.n = m.n",
    )


def band_one(aggregate: str, name: str) -> str:
    return sql(
        [*PIXELS, *REQUESTS, ("s", f"SELECT n, round({aggregate}, 6) AS v FROM pixels WHERE band = 1 GROUP BY n")],
        f"SELECT id, v AS {name} FROM requests q LEFT JOIN s ON q.n = s.n",
    )


def number(x: str) -> str:
    """Shortest digits without a trailing .0, for the few values in the files."""
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def fixed(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {x})"


def _dense() -> Ctes:
    """Cells per event type, of levels 1 to 4, each once."""
    made = "SELECT DISTINCT event_type, cell FROM tagged JOIN events ON id = event_id"
    return [*cells("1 + id % 4"), ("dense", made)]


def _inside(a: str, b: str) -> str:
    return f"{a}.cell <> {b}.cell AND {a}.cell BETWEEN {low(b + '.cell')} AND {high(b + '.cell')}"


def _segments() -> Ctes:
    """Wide cells by face, others by their ancestor at level 3, without those inside another of their segment."""
    segment = f"if({level_of('cell')} < 3, {up('cell', '0')}, {up('cell', '3')})"
    return [
        *_dense(), ("keyed", f"SELECT *, {segment} AS segment, {level_of('cell')} < 3 AS wide FROM dense"),
        ("outer_", "SELECT * FROM keyed a WHERE NOT EXISTS (SELECT 1 FROM keyed b WHERE a.event_type = b.event_type "
         f"AND a.segment = b.segment AND a.wide = b.wide AND {_inside('a', 'b')})"),
    ]


def _normal() -> str:
    """From the finest level up: four siblings go on as their parent, others stay."""
    ctes = [
        *_dense(),
        ("apart", f"SELECT * FROM dense a WHERE NOT EXISTS (SELECT 1 FROM dense b WHERE a.event_type = b.event_type AND {_inside('a', 'b')})"),
        ("up4", f"SELECT event_type, cell FROM apart WHERE {level_of('cell')} = 4"),
    ]
    for k in (4, 3, 2, 1):
        parent = up("cell", str(k - 1))
        ctes += [
            (f"n{k}", f"SELECT *, {parent} AS parent, count(*) OVER (PARTITION BY event_type, {parent}) AS c FROM up{k}"),
            (f"up{k - 1}", f"SELECT DISTINCT event_type, parent AS cell FROM n{k} WHERE c = 4 "
             f"UNION ALL SELECT event_type, cell FROM apart WHERE {level_of('cell')} = {k - 1}"),
        ]
    return sql(ctes, " UNION ALL ".join(f"SELECT event_type, cell FROM n{k} WHERE c < 4" for k in (4, 3, 2, 1)) + " UNION ALL SELECT event_type, cell FROM up0")


ORACLE: dict[str, str] = {
    "s2_cell_id": sql(cells(), "SELECT id, level, cell FROM tagged"),
    "s2_parent": sql(cells(), "SELECT id, cell AS parent FROM tagged"),
    "s2_cell_level": sql(cells(), f"SELECT id, {level_of('cell')}::INTEGER AS found FROM tagged"),
    "s2_cell_to_hex": sql(cells(), f"SELECT id, {token('cell')} AS token FROM tagged"),
    "s2_hex_to_cell": sql(cells(), "SELECT id, CASE WHEN id % 10 = 3 THEN 0 ELSE cell END AS cell FROM tagged"),
    "s2_contains": sql(
        [
            *cells("6 + id % 7"),
            ("moved", "SELECT *, lat + (id % 5) * 0.03e0 AS lat2 FROM tagged"),
            *leaf("moved", "m", "lat2", "lon"),
        ],
        f"SELECT id, mleaf BETWEEN {low('cell')} AND {high('cell')} AS inside FROM m_leaf",
    ),
    "s2_distance_meters": sql(
        [
            *cells("10"),
            *leaf("tagged", "e", "(-lat + 0.5e0)", "(lon / 2)"),
            ("pair", f"SELECT id, cell, {up('eleaf', '8')} AS other FROM e_leaf"),
            *center("pair", "p", "cell"),
            *center("p_center", "q", "other"),
        ],
        f"SELECT id, round(acos(greatest(least(pcx * qcx + pcy * qcy + pcz * qcz, 1), -1)) * {R}, 3) AS meters "
        "FROM q_center",
    ),
    "s2_area_m2": sql(
        [*cells("id % 21"), ("r_src", "SELECT id, cell FROM tagged"), *area("r", "cell")],
        f"SELECT id, round(rarea * {R} * {R} / 1000, 1) AS area_1000_m2 FROM r_area",
    ),
    "s2_to_geo": sql([*cells(), *center("tagged", "p", "cell")], f"SELECT id, {geo('pc')} FROM p_center"),
    "s2_cell_vertex": sql(
        [
            *cells("1 + id % 30"),
            *decode("tagged", "p", "cell"),
            *bounds("p"),
            (
                "corner",
                "SELECT *, CASE WHEN id % 4 IN (1, 2) THEN pu1 ELSE pu0 END AS ku, "
                "CASE WHEN id % 4 IN (2, 3) THEN pv1 ELSE pv0 END AS kv FROM p_bound",
            ),
            *face_xyz("corner", "k", "pf", "ku", "kv", "k"),
        ],
        f"SELECT id, {geo('k')} FROM k",
    ),
    "s2_cell_id_from_point": sql(
        [
            (
                "points",
                "SELECT event_id AS id, CAST((event_id * 7919) % 360 - 180 || '.00713' AS DOUBLE) AS lon, "
                "CAST((event_id * 104729) % 168 - 84 || '.00317' AS DOUBLE) AS lat FROM events",
            ),
            *leaf("points", "a"),
        ],
        "SELECT id, CASE WHEN id % 7 = 4 THEN 0 ELSE aleaf END AS cell FROM a_leaf",
    ),
    "s2_children": sql(
        [
            *cells("5 + id % 4"),
            ("n", "SELECT id, cell, level, unnest(range(0, power(4, 8 - level)::BIGINT)) AS k FROM tagged"),
        ],
        f"SELECT id, {low('cell')} - 1 + {bit('8')} * (2 * k + 1) AS child_id FROM n",
    ),
    "s2_cell_neighbors": sql([*cells(), *neighbors("tagged", "cell")], "SELECT id, neighbor_id FROM near"),
    "s2_covering_level": _fence_cells(inside=False),
    "s2_interior_covering_level": _fence_cells(inside=True),
    "s2_covering_points": sql(
        [*POINTS, *FENCES],
        "SELECT id, fence FROM points JOIN ordered ON lat BETWEEN lat_lo AND lat_hi AND lon BETWEEN lon_lo AND lon_hi",
    ),
    "s2_interior_covering_points": sql(FENCES, "SELECT fence, 0::BIGINT AS n_outside FROM ordered"),
    "s2_bounds_of_collections": sql(
        FENCES,
        "SELECT fence, CASE WHEN fence % 5 <> 1 THEN least(lat_lo, 0) END AS lat_lo, "
        "CASE WHEN fence % 5 <> 1 THEN greatest(lat_hi, 3) END AS lat_hi, "
        "CASE WHEN fence % 5 <> 1 THEN least(lon_lo, 0) END AS lon_lo, "
        "CASE WHEN fence % 5 <> 1 THEN greatest(lon_hi, 3) END AS lon_hi FROM ordered",
    ),
    "s2_cell_union_pack": sql(
        UNIONS,
        f"SELECT id, '03000000' || {little_endian('cell')} || {little_endian('other')} || {little_endian('cell')} "
        "AS blob_hex FROM two",
    ),
    "s2_cell_union_contains": sql(
        [
            *UNIONS,
            ("w", "SELECT *, CASE WHEN id % 3 = 0 THEN cell ELSE other END AS pick FROM two"),
            ("probes", f"SELECT *, {up('pick', '(5 + id % 4)')} AS probe FROM w"),
        ],
        f"SELECT id, probe BETWEEN {low('cell')} AND {high('cell')} OR probe BETWEEN {low('other')} AND {high('other')} "
        "AS held FROM probes",
    ),
    "s2_cell_union_intersects": sql(
        [
            *UNIONS,
            ("w", f"SELECT *, {up('cell', '(id % 9)')} AS own FROM two"),
            ("probes", f"SELECT *, CASE WHEN id % 2 = 0 THEN own ELSE xor(own, {TOP}) END AS probe FROM w"),
        ],
        f"SELECT id, ({low('probe')} <= {high('cell')} AND {low('cell')} <= {high('probe')}) OR "
        f"({low('probe')} <= {high('other')} AND {low('other')} <= {high('probe')}) AS met FROM probes",
    ),
    "s2_cell_union_area": sql(
        [
            *UNIONS,
            (
                "r_src",
                "SELECT id, cell AS c FROM two UNION ALL SELECT id, cell FROM two UNION ALL SELECT id, other FROM two",
            ),
            *area("r", "c"),
        ],
        f"SELECT id, round(sum(rarea * {R} * {R}) / 1e6, 1) AS area_km2 FROM r_area GROUP BY id",
    ),
    "cell_union_agg": sql(
        [
            *cells("6"),
            (
                "g",
                "SELECT event_type, count(*) AS n, string_agg(upper("
                + little_endian("cell")
                + "), '' ORDER BY cell < 0, cell) AS body FROM tagged JOIN events ON id = event_id GROUP BY 1",
            ),
        ],
        "SELECT event_type, CAST(4 + 8 * n AS INTEGER) AS n_bytes, md5("
        + " || ".join(f"substr(lpad(upper(to_hex(n)), 8, '0'), {k}, 2)" for k in (7, 5, 3, 1))
        + " || body) AS digest FROM g",
    ),
    "cell_union_counts": sql(
        cells("6"), "SELECT event_type, cell, count(*) AS n FROM tagged JOIN events ON id = event_id GROUP BY 1, 2"
    ),
    "s2_cell_union_unpack": sql(
        UNIONS, "SELECT id, unnest([0, 1, 2]) AS place, unnest([cell, other, cell]) AS cell FROM two"
    ),
    "cell_union_normalize": sql(
        [*cells("3 + id % 5"), ("q", "SELECT id, cell, (cell & -cell) // 4 AS s FROM tagged")],
        "SELECT id, cell FROM q WHERE id % 3 < 2 UNION ALL "
        "SELECT id, cell + unnest([-3, -1, 1]) * s AS cell FROM q WHERE id % 3 = 2",
    ),
    "cell_union_segments": sql(
        _segments(),
        "SELECT event_type, wide, segment, min(cell) AS first, max(cell) AS last, count(*) AS n, "
        "md5(string_agg(CAST(cell AS VARCHAR), ',' ORDER BY cell)) AS digest FROM outer_ GROUP BY 1, 2, 3",
    ),
    "cell_union_segments_contain": sql(
        [*_dense(), ("asked", f"SELECT id, event_type, {up('aleaf', 'id % 7')} AS cell FROM a_leaf JOIN events ON id = event_id")],
        "SELECT id, EXISTS (SELECT 1 FROM dense WHERE dense.event_type = asked.event_type "
        f"AND asked.cell BETWEEN {low('dense.cell')} AND {high('dense.cell')}) AS held FROM asked",
    ),
    "s2_cell_union_normalize": _normal(),
    "s2_point_in_cells_join": sql(
        [
            *POINTS,
            *leaf("points", "a"),
            *PLACES,
            *leaf("places", "h"),
            ("areas", f"SELECT place, {up('hleaf', '(4 + place % 4)')} AS cell_id FROM h_leaf"),
        ],
        f"SELECT id, place, cell_id FROM a_leaf JOIN areas ON aleaf BETWEEN {low('cell_id')} AND {high('cell_id')}",
    ),
    "s2_point_in_fences_join": sql(
        [*POINTS, *FENCES],
        "SELECT id, fence FROM points JOIN ordered ON lat BETWEEN lat_lo AND lat_hi AND lon BETWEEN lon_lo AND lon_hi",
    ),
    "s2_cell_density": sql(
        [
            *POINTS,
            *leaf("points", "a"),
            ("each", "SELECT aleaf, unnest([4, 6, 8]) AS level FROM a_leaf"),
        ],
        f"SELECT level, {up('aleaf', 'level')} AS cell_id, count(*) AS n FROM each GROUP BY 1, 2",
    ),
    "s2_neighbor_join": sql(
        [
            *POINTS,
            *leaf("points", "a"),
            ("counts", f"SELECT {up('aleaf', '5')} AS cell, count(*) AS n FROM a_leaf GROUP BY 1"),
            *PLACES,
            *leaf("places", "h"),
            ("home", f"SELECT place, {up('hleaf', '5')} AS home_cell FROM h_leaf"),
            *neighbors("home", "home_cell"),
        ],
        "SELECT place, CAST(sum(n) AS BIGINT) AS n_near FROM near JOIN counts ON neighbor_id = cell GROUP BY place",
    ),
    "s2_union_overlap_join": sql(
        [
            *POINTS,
            *leaf("points", "a"),
            *PLACES,
            *leaf("places", "h"),
            ("l", f"SELECT DISTINCT place % 100 AS region, {up('hleaf', '(4 + place % 4)')} AS c FROM h_leaf"),
            ("r", f"SELECT DISTINCT id % 100 AS \"user\", {up('aleaf', '(3 + id % 6)')} AS d FROM a_leaf"),
        ],
        f"SELECT DISTINCT region, \"user\" FROM l JOIN r ON {low('c')} <= {high('d')} AND {low('d')} <= {high('c')}",
    ),
    "rs_metadata": sql(FILES, "SELECT file, width, height, bands, crs FROM meta"),
    "rs_width": header("width", "0", "rs_width"),
    "rs_height": header("height", "0", "rs_height"),
    "rs_band_count": header("bands", "0", "rs_band_count"),
    "rs_geo_transform": header(
        f"{number('gt0')} || ',0.25,0,' || {number('gt3')} || ',0,' || {number('gt5')}", "'0,1,0,0,0,-1'", "rs_geo_transform"
    ),
    "rs_scale_x": header("gt1", "1e0", "rs_scale_x"),
    "rs_scale_y": header("abs(gt5)", "1e0", "rs_scale_y"),
    "rs_crs": header("crs", "''", "rs_crs"),
    "rs_nodata": header("nodata", "NULL", "rs_nodata"),
    "rs_value": sql(
        [*PIXELS, *REQUESTS],
        "SELECT q.id, p.value FROM requests q LEFT JOIN pixels p ON q.n = p.n "
        "AND p.band = least(greatest(q.band, 1), 2) AND p.c = greatest(q.col, 0) AND p.r = greatest(q.rw, 0)",
    ),
    "rs_pixel_to_world": header(
        f"'POINT(' || {fixed('gt0 + (col + 0.5e0) * gt1', 7)} || ' ' || {fixed('gt3 + (rw + 0.25e0) * gt5', 7)} || ')'",
        "'POINT(NaN NaN)'",
        "point_text",
    ),
    "rs_world_to_pixel": sql(
        [*FILES, *REQUESTS],
        "SELECT id, round((col * 2.5e0 - gt0) / gt1, 2) AS pixel_col, round((rw * 1.5e0 - gt3) / gt5, 2) AS pixel_row "
        "FROM requests q LEFT JOIN meta m ON q.n = m.n",
    ),
    "rs_sample_points": sql(
        [*PIXELS, *REQUESTS],
        "SELECT q.id, p.value FROM requests q LEFT JOIN pixels p ON q.n = p.n AND p.band = 1 AND p.c = q.col AND p.r = q.rw",
    ),
    "rs_stats": sql(
        PIXELS,
        "SELECT 'r' || n || '.tif' AS file, band, round(min(value), 6) AS min, round(max(value), 6) AS max, "
        "round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS stddev, count(*) AS count FROM pixels GROUP BY n, band",
    ),
    "rs_stats_without_nodata": sql(
        PIXELS,
        "SELECT 'r' || n || '.tif' AS file, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, "
        "round(stddev_pop(value), 6) AS stddev, count(*) AS count FROM pixels WHERE band = 2 AND value <> 4 GROUP BY n",
    ),
    "rs_stats_without_header_nodata": sql(
        PIXELS,
        "SELECT 'r' || n || '.tif' AS file, band, round(min(value), 6) AS min, round(max(value), 6) AS max, "
        "round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS stddev, count(*) AS count FROM pixels "
        "WHERE n % 3 = 2 OR value <> 4 GROUP BY n, band",
    ),
    "rs_histogram": sql(
        [
            *PIXELS,
            ("b", "SELECT n, band, min(value) AS lo, (max(value) - min(value)) / 16e0 AS w FROM pixels GROUP BY 1, 2"),
            ("bins", "SELECT *, unnest(range(0, 16)) AS bin FROM b"),
            (
                "hits",
                "SELECT p.n, p.band, floor((value - lo) / w)::BIGINT AS bin, count(*) AS c FROM pixels p "
                "JOIN b ON p.n = b.n AND p.band = b.band GROUP BY 1, 2, 3",
            ),
        ],
        "SELECT 'r' || bins.n || '.tif' AS file, bins.band, CAST(bins.bin AS INTEGER) AS bin, "
        "round(lo + (bins.bin + 0.5e0) * w, 6) AS value, coalesce(c, 0) AS count "
        "FROM bins LEFT JOIN hits ON bins.n = hits.n AND bins.band = hits.band AND bins.bin = hits.bin",
    ),
    "rs_min": band_one("min(value)", "rs_min"),
    "rs_max": band_one("max(value)", "rs_max"),
    "rs_mean": band_one("avg(value)", "rs_mean"),
    "rs_stddev": band_one("stddev_pop(value)", "rs_stddev"),
    "rs_pixels": sql(
        PIXELS,
        "SELECT 'r' || n || '.tif' AS file, band, CAST(r AS INTEGER) AS pixel_row, CAST(c AS INTEGER) AS pixel_col, "
        "value FROM pixels",
    ),
    "rs_tiles": sql(
        PIXELS,
        "SELECT 'r' || n || '.tif' AS file, band, CAST(r AS INTEGER) AS pixel_row, count(*) AS n, "
        "round(sum(value), 4) AS total FROM pixels GROUP BY 1, 2, 3",
    ),
}
