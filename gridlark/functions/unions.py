"""Cell unions: a count and the ids, little endian, in one binary; or an array of longs."""

from __future__ import annotations

from . import cells
from .formula import Formula


def _reversed_bytes(hex_text: str, size: int) -> str:
    parts = ", ".join(f"substr({hex_text}, {2 * k - 1}, 2)" for k in range(size, 0, -1))
    return f"concat({parts})"


def packed(ids: str) -> str:
    count = f"transform(array(lpad(hex(size({ids})), 8, '0')), n -> {_reversed_bytes('n', 4)})[0]"
    body = (
        f"array_join(transform(transform({ids}, c -> lpad(hex(c), 16, '0')), "
        f"h -> {_reversed_bytes('h', 8)}), '')"
    )
    return f"unhex(concat({count}, {body}))"


def unpacked(blob: str) -> str:
    """Ids of a union blob; fewer than 4 bytes give none, a cut-off last id is left out."""
    stated = f"CAST(conv({_reversed_bytes(f'hex(substr({blob}, 1, 4))', 4)}, 16, 10) AS BIGINT)"
    count = f"least({stated}, CAST((octet_length({blob}) - 4) DIV 8 AS BIGINT))"
    texts = f"transform(sequence(1L, {count}), k -> hex(substr({blob}, CAST(8 * k - 3 AS INT), 8)))"
    ids = f"transform({texts}, h -> CAST(conv({_reversed_bytes('h', 8)}, 16, -10) AS BIGINT))"
    return (
        f"CASE WHEN {blob} IS NULL THEN NULL WHEN octet_length({blob}) < 12 OR {stated} = 0 "
        f"THEN CAST(array() AS ARRAY<BIGINT>) ELSE {ids} END"
    )


_TOKENS = "filter(transform(split({csv}, ','), t -> btrim(t, ' \\t\\n\\r')), t -> t <> '')"

s2_cell_union_pack = Formula(
    "s2_cell_union_pack",
    {"csv": "string"},
    "binary",
    packed("{ids}"),
    [{"ids": f"transform({_TOKENS}, t -> {cells.cell_of_token('t')})"}],
)

s2_cell_union_unpack = Formula("s2_cell_union_unpack", {"blob": "binary"}, "array<bigint>", unpacked("{blob}"))

s2_cell_union_of = Formula("s2_cell_union_of", {"ids": "array<bigint>"}, "binary", packed("{ids}"))

s2_cell_union_contains = Formula(
    "s2_cell_union_contains",
    {"blob": "binary", "cell": "bigint"},
    "boolean",
    "CASE WHEN {cell} IS NOT NULL THEN exists({ids}, "
    f"c -> {{cell}} BETWEEN {cells.range_min('c')} AND {cells.range_max('c')}) END",
    [{"ids": unpacked("{blob}")}],
)

# Expression form, all pairs of cells: for large unions use operators.unions.add_union_intersects.
s2_cell_union_intersects = Formula(
    "s2_cell_union_intersects",
    {"blob1": "binary", "blob2": "binary"},
    "boolean",
    "CASE WHEN {ids1} IS NOT NULL AND {ids2} IS NOT NULL THEN exists({ids1}, a -> exists({ids2}, b -> "
    f"{cells.range_min('a')} <= {cells.range_max('b')} AND {cells.range_min('b')} <= {cells.range_max('a')})) END",
    [{"ids1": unpacked("{blob1}"), "ids2": unpacked("{blob2}")}],
)

_one_area = Formula(
    "s2_cell_area", {"cell": "bigint"}, "double", f"{{area}} * ({cells.R} * {cells.R})", cells.area_steps()
)

# Expression form only: for many cells use operators.unions.union_area.
s2_cell_union_area = Formula(
    "s2_cell_union_area",
    {"blob": "binary"},
    "double",
    f"aggregate({unpacked('{blob}')}, 0D, (total, c) -> total + {_one_area.sql('c').replace('`c`', 'c')})",
)
