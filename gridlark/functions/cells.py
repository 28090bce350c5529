"""Cell ids as plain longs: bit arithmetic, tokens and the sphere geometry.

A cell id is a 64-bit pattern kept in a signed long, so ids of faces 4 and 5
are negative.  Texts below are Spark SQL; ``{name}`` stands for a value.
"""

from __future__ import annotations

from . import fixed
from .formula import Cut, Formula, Loop

R = f"{fixed.EARTH_RADIUS_M!r}D"
MASK30 = (1 << 30) - 1


def _array(values: list[int]) -> str:
    return "array(" + ",".join(f"{v}L" for v in values) + ")"


_IJ_TABLE = _array(fixed.ij_table())
_POS_TABLE = _array(fixed.pos_table())


# -- text snippets -------------------------------------------------------------
def lsb(cell: str) -> str:
    # id & -id without overflow: the one pattern that has no predecessor is no valid id
    safe = f"greatest({cell}, -9223372036854775807L)"
    return f"({safe} ^ ({safe} & ({safe} - 1L)))"


def level_lsb(level: str) -> str:
    return f"shiftleft(1L, CAST(2 * (30 - {level}) AS INT))"


def level_of(cell: str) -> str:
    return f"CAST(30 - bit_count({lsb(cell)} - 1L) DIV 2 AS INT)"


def ancestor(cell: str, level: str) -> str:
    bit = level_lsb(level)
    return f"CASE WHEN {level} BETWEEN 0 AND 30 THEN ({cell} & -{bit}) | {bit} END"


def range_min(cell: str) -> str:
    return f"({cell} - ({lsb(cell)} - 1L))"


def range_max(cell: str) -> str:
    return f"({cell} + ({lsb(cell)} - 1L))"


def unsigned_order(cell: str) -> str:
    """Sort key that puts signed ids in cell order."""
    return f"({cell} ^ -9223372036854775808L)"


def token_of(cell: str) -> str:
    return f"CASE WHEN {cell} = 0 THEN 'X' ELSE rtrim('0', lower(lpad(hex({cell}), 16, '0'))) END"


def cell_of_token(token: str) -> str:
    return (
        f"CASE WHEN {token} IS NULL THEN NULL WHEN {token} RLIKE '^[0-9a-fA-F]{{{{1,16}}}}$' "
        f"THEN CAST(conv(rpad({token}, 16, '0'), 16, -10) AS BIGINT) ELSE 0L END"
    )


def choose(selector: str, *values: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values[:-1]))
    return f"CASE {selector} {cases} ELSE {values[-1]} END"


# -- steps: latitude/longitude to cell -----------------------------------------
def point_steps(lat: str = "{lat}", lon: str = "{lon}") -> list[dict[str, str]]:
    # values are kept non-null (smaller generated code); ``known`` tells if they count
    return [
        {
            "known": f"{lat} IS NOT NULL AND {lon} IS NOT NULL",
            "lat": f"coalesce({lat}, 0D)",
            "lon": f"coalesce({lon}, 0D)",
        },
        {
            "x": "cos(radians({lat})) * cos(radians({lon}))",
            "y": "cos(radians({lat})) * sin(radians({lon}))",
            "z": "sin(radians({lat}))",
        }
    ]


FACE_STEP = {
    "f": "CASE WHEN abs({x}) > abs({y}) AND abs({x}) > abs({z}) THEN if({x} < 0, 3L, 0L) "
    "WHEN abs({x}) <= abs({y}) AND abs({y}) > abs({z}) THEN if({y} < 0, 4L, 1L) "
    "ELSE if({z} < 0, 5L, 2L) END"
}
# component along the face axis (positive on the face) and the two others
AXES_STEP = {
    "d": choose("{f}", "{x}", "{y}", "{z}", "-{x}", "-{y}", "-{z}"),
    "p": choose("{f}", "{y}", "-{x}", "-{x}", "-{z}", "-{z}", "{y}"),
    "q": choose("{f}", "{z}", "{z}", "-{y}", "-{y}", "{x}", "{x}"),
}
UV_STEP = {"u": "{p} / {d}", "v": "{q} / {d}"}


def _st(u: str) -> str:
    return f"if({u} >= 0, 0.5D * sqrt(1D + 3D * {u}), 1D - 0.5D * sqrt(1D - 3D * {u}))"


def to_index(s: str) -> str:
    return f"least(floor(1073741824D * {s}), {MASK30}L)"


ST_STEP = {"s": _st("{u}"), "t": _st("{v}")}
IJ_STEP = {"i": to_index("{s}"), "j": to_index("{t}")}


def encode_steps() -> list[dict[str, str]]:
    """(f, i, j) -> leaf id, two Hilbert levels per turn (30 levels = 15 turns)."""
    index = (
        "shiftleft({w} & 3L, 4) | shiftleft(shiftright({i}, {k}) & 3L, 2) | (shiftright({j}, {k}) & 3L)"
    )
    return [
        Loop(
            28,
            0,
            -2,
            {"w": "{f} & 1L", "pos": "0L"},
            {
                "w": f"coalesce({_IJ_TABLE}[{index}], 0L)",
                "pos": "shiftleft({pos}, 4) | shiftright({w}, 2)",
            },
        ),
        Cut(pos="shiftleft({pos}, 4) | shiftright({w}, 2)"),
        {"leaf": "shiftleft({f}, 61) | shiftleft({pos}, 1) | 1L"},
    ]


def leaf_steps() -> list[dict[str, str]]:
    return [*point_steps(), FACE_STEP, AXES_STEP, UV_STEP, ST_STEP, IJ_STEP, *encode_steps()]


# -- steps: cell to square on its face -----------------------------------------
def decode_steps(cell: str = "{cell}", tag: str = "") -> list[dict[str, str]]:
    """Cell id -> face, and the low corner and size of its square in leaf units."""

    def n(name: str) -> str:
        return "{" + name + tag + "}"

    index = f"shiftleft({n('w')} & 3L, 4) | (shiftright({n('pos')}, {{k}}) & 15L)"
    look = f"coalesce({_POS_TABLE}[{index}], 0L)"
    i = f"(shiftleft({n('i')}, 2) | shiftright({n('w')}, 4))"
    j = f"(shiftleft({n('j')}, 2) | (shiftright({n('w')}, 2) & 3L))"
    return [
        {f"known{tag}": f"{cell} IS NOT NULL", f"id{tag}": f"coalesce({cell}, 1L)"},
        {
            f"f{tag}": f"shiftrightunsigned({n('id')}, 61)",
            f"pos{tag}": f"shiftrightunsigned({n('id')} & 2305843009213693951L, 1)",
            f"size{tag}": f"shiftleft(1L, bit_count({lsb(n('id'))} - 1L) DIV 2)",
        },
        Loop(
            56,
            0,
            -4,
            {f"w{tag}": f"{n('f')} & 1L", f"i{tag}": "0L", f"j{tag}": "0L"},
            {f"w{tag}": look, f"i{tag}": i, f"j{tag}": j},
        ),
        {f"i{tag}": f"{i} & -{n('size')}", f"j{tag}": f"{j} & -{n('size')}"},
        Cut({f"size{tag}": n("size")}),
    ]


def _uv(s: str) -> str:
    return (
        f"if({s} >= 0.5D, (1D / 3D) * (4D * {s} * {s} - 1D), "
        f"(1D / 3D) * (1D - 4D * (1D - {s}) * (1D - {s})))"
    )


BOUND_STEPS = [
    {
        "s0": "{i} / 1073741824D",
        "s1": "({i} + {size}) / 1073741824D",
        "t0": "{j} / 1073741824D",
        "t1": "({j} + {size}) / 1073741824D",
    },
    {"u0": _uv("{s0}"), "u1": _uv("{s1}"), "v0": _uv("{t0}"), "v1": _uv("{t1}")},
]


def face_xyz(u: str, v: str, tag: str = "", f: str = "{f}") -> dict[str, str]:
    """Direction (not normalized) of a face point."""
    return {
        f"x{tag}": choose(f, "1D", f"-{u}", f"-{u}", "-1D", v, v),
        f"y{tag}": choose(f, u, "1D", f"-{v}", f"-{v}", "-1D", u),
        f"z{tag}": choose(f, v, v, "1D", f"-{u}", f"-{u}", "-1D"),
    }


def unit(tag: str = "") -> list[dict[str, str]]:
    x, y, z, n = (f"{{{c}{tag}}}" for c in ("x", "y", "z", "n"))
    return [
        {f"n{tag}": f"sqrt({x} * {x} + {y} * {y} + {z} * {z})"},
        {f"x{tag}": f"{x} / {n}", f"y{tag}": f"{y} / {n}", f"z{tag}": f"{z} / {n}"},
    ]


def together(*runs: list[dict[str, str]]) -> list[dict[str, str]]:
    """Run equally long step lists side by side."""
    merged = []
    for group in zip(*runs, strict=True):
        step = group[0]
        for other in group[1:]:
            step = step.together(other) if isinstance(step, Loop) else {**step, **other}
        merged.append(step)
    return merged


def center_steps(cell: str = "{cell}", tag: str = "") -> list[dict[str, str]]:
    i, j, size, s, t, u, v, f = (f"{{{c}{tag}}}" for c in ("i", "j", "size", "s", "t", "u", "v", "f"))
    return [
        *decode_steps(cell, tag),
        {
            f"s{tag}": f"(2 * {i} + {size}) / 2147483648D",
            f"t{tag}": f"(2 * {j} + {size}) / 2147483648D",
        },
        {f"u{tag}": _uv(s), f"v{tag}": _uv(t)},
        face_xyz(u, v, tag, f),
        *unit(tag),
    ]


# atan2 in Spark takes -0.0 for 0.0; these are the places where the sign of zero shows
LON = (
    "CASE WHEN {y} = 0 AND {f} IN (2L, 3L) THEN if({x} <= 0, -180D, -0.0D) ELSE degrees(atan2({y}, {x})) END"
)
LAT = (
    "CASE WHEN {z} = 0 AND {f} IN (3L, 4L) THEN -0.0D "
    "ELSE degrees(atan2({z}, sqrt({x} * {x} + {y} * {y}))) END"
)
POINT_TEXT = f"format_string('POINT(%.7f %.7f)', {LON}, {LAT})"


# -- area ------------------------------------------------------------------------
_CORNERS = [("{u0}", "{v0}"), ("{u1}", "{v0}"), ("{u1}", "{v1}"), ("{u0}", "{v1}")]


def area_steps(cell: str = "{cell}") -> list[dict[str, str]]:
    """Approximate area of a cell, steradians, as value ``area``."""
    diagonals = {
        f"{axis}{name}": f"{{{axis}{b}}} - {{{axis}{a}}}"
        for name, a, b in (("p", 0, 2), ("q", 1, 3))
        for axis in "xyz"
    }
    cross = (
        "power({yp} * {zq} - {zp} * {yq}, 2) + power({zp} * {xq} - {xp} * {zq}, 2)"
        " + power({xp} * {yq} - {yp} * {xq}, 2)"
    )
    return [
        *decode_steps(cell),
        *BOUND_STEPS,
        {k: v for n, (u, w) in enumerate(_CORNERS) for k, v in face_xyz(u, w, str(n)).items()},
        *together(*(unit(str(n)) for n in range(4))),
        Cut(size="{size}"),
        diagonals,
        {"flat": f"0.5D * sqrt({cross})"},
        {
            "area": "CASE WHEN {size} = 1073741824L THEN 4D * pi() / 6D "
            "WHEN {size} = 536870912L THEN 4D * pi() / 24D "
            "ELSE {flat} * 2D / (1D + sqrt(1D - least({flat} / pi(), 1D))) END"
        },
    ]


def when_known(text: str) -> str:
    return f"CASE WHEN {{known}} THEN {text} END"


# -- the functions ---------------------------------------------------------------
s2_cell_id = Formula(
    "s2_cell_id",
    {"lat": "double", "lon": "double", "level": "bigint"},
    "bigint",
    when_known(ancestor("{leaf}", "{level}")),
    leaf_steps(),
)

s2_parent = Formula(
    "s2_parent", {"cell": "bigint", "level": "bigint"}, "bigint", ancestor("{cell}", "{level}")
)

s2_cell_level = Formula(
    "s2_cell_level", {"cell": "bigint"}, "int", f"CASE WHEN {{cell}} NOT IN (0L, -9223372036854775807L - 1L) THEN {level_of('{cell}')} END"
)

s2_cell_to_hex = Formula("s2_cell_to_hex", {"cell": "bigint"}, "string", token_of("{cell}"))

s2_hex_to_cell = Formula("s2_hex_to_cell", {"token": "string"}, "bigint", cell_of_token("{token}"))

s2_contains = Formula(
    "s2_contains",
    {"cell": "bigint", "lat": "double", "lon": "double"},
    "boolean",
    "CASE WHEN NOT ({known} AND {known_cell}) THEN NULL WHEN {d} > 0 THEN "
    "{p} / {d} BETWEEN {u0} - {e} AND {u1} + {e} AND {q} / {d} BETWEEN {v0} - {e} AND {v1} + {e} "
    "ELSE false END",
    [*decode_steps(), {"known_cell": "{known}"}, *point_steps(), AXES_STEP, *BOUND_STEPS, {"e": f"{fixed.UV_MARGIN!r}D"}],
)

s2_distance_meters = Formula(
    "s2_distance_meters",
    {"cell1": "bigint", "cell2": "bigint"},
    "double",
    f"CASE WHEN {{known1}} AND {{known2}} THEN acos(greatest(least({{dot}}, 1D), -1D)) * {R} END",
    [
        *together(center_steps("{cell1}", "1"), center_steps("{cell2}", "2")),
        {"dot": "{x1} * {x2} + {y1} * {y2} + {z1} * {z2}"},
    ],
)

s2_area_m2 = Formula(
    "s2_area_m2",
    {"cell": "bigint", "level": "int"},
    "double",
    when_known(f"{{area}} * ({R} * {R})"),
    [{"up": ancestor("{cell}", "{level}")}, *area_steps("{up}")],
)

s2_to_geo = Formula("s2_to_geo", {"cell": "bigint"}, "string", when_known(POINT_TEXT), center_steps())

s2_cell_vertex = Formula(
    "s2_cell_vertex",
    {"cell": "bigint", "k": "int"},
    "string",
    f"CASE WHEN {{k}} IS NULL OR NOT {{known}} THEN NULL WHEN {{k}} BETWEEN 0 AND 3 "
    f"THEN {POINT_TEXT} ELSE '' END",
    [
        *decode_steps(),
        *BOUND_STEPS,
        {"u": "if({k} IN (1, 2), {u1}, {u0})", "v": "if({k} IN (2, 3), {v1}, {v0})"},
        face_xyz("{u}", "{v}"),
        *unit(),
    ],
)

# down, right, up, left for k = 0..3
s2_edge_neighbor = Formula(
    "s2_edge_neighbor",
    {"cell": "bigint", "k": "int"},
    "bigint",
    when_known("({leaf} & -({size} * {size})) | ({size} * {size})"),
    [
        *decode_steps(),
        {
            "known_cell": "{known} AND {k} BETWEEN 0 AND 3",
            "i": "greatest(least({i} + CASE {k} WHEN 1 THEN {size} WHEN 3 THEN -{size} ELSE 0L END, "
            "1073741824L), -1L)",
            "j": "greatest(least({j} + CASE {k} WHEN 2 THEN {size} WHEN 0 THEN -{size} ELSE 0L END, "
            "1073741824L), -1L)",
        },
        {
            n: f"greatest(least((2 * {{{w}}} + 1 - 1073741824L) / 1073741824D, {1 + fixed.UV_MARGIN!r}D), "
            f"{-1 - fixed.UV_MARGIN!r}D)"
            for n, w in (("u", "i"), ("v", "j"))
        },
        face_xyz("{u}", "{v}"),
        FACE_STEP,
        AXES_STEP,
        UV_STEP,
        {"s": "0.5D * ({u} + 1D)", "t": "0.5D * ({v} + 1D)"},
        IJ_STEP,
        *encode_steps(),
        {"known": "{known_cell}"},
    ],
)
