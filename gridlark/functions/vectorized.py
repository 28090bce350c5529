"""Arrow batches of the cell functions that take many steps, for their SQL names.

As SQL functions their steps would be bound by lambdas, which Spark interprets; a batch in numpy is about as fast as the
staged form.  Results are those of ``cells``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed

_IJ = np.array(fixed.ij_table(), np.int64)
_POS = np.array(fixed.pos_table(), np.int64)
_SIDE = 1 << fixed.MAX_LEVEL


def _numbers(column: pa.Array, kind: type) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(kind)


def _known(*columns: pa.Array) -> np.ndarray:
    return np.logical_and.reduce([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])


def _direction(lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, ...]:
    lat, lon = np.radians(lat), np.radians(lon)
    return np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)


def _axes(f: np.ndarray, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, ...]:
    """The component along the face's axis and the two others."""
    return np.choose(f, [x, y, z, -x, -y, -z]), np.choose(f, [y, -x, -x, -z, -z, y]), np.choose(f, [z, z, -y, -y, x, x])


def _leaf(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    x, y, z = _direction(lat, lon)
    a, b, c = np.abs(x), np.abs(y), np.abs(z)
    f = np.where((a > b) & (a > c), np.where(x < 0, 3, 0), np.where((a <= b) & (b > c), np.where(y < 0, 4, 1), np.where(z < 0, 5, 2)))
    d, p, q = _axes(f, x, y, z)
    place = []
    for w in (p / d, q / d):
        s = np.where(w >= 0, 0.5 * np.sqrt(1 + 3 * np.abs(w)), 1 - 0.5 * np.sqrt(1 + 3 * np.abs(w)))
        place.append(np.minimum(np.floor(_SIDE * s), _SIDE - 1).astype(np.int64))
    i, j = place
    turn, pos = f.astype(np.int64) & 1, np.zeros(len(f), np.int64)
    for k in range(28, -1, -2):
        turn = _IJ[(turn & 3) << 4 | (i >> k & 3) << 2 | j >> k & 3]
        pos = pos << 4 | turn >> 2
    return (f.astype(np.uint64) << np.uint64(61)).astype(np.int64) | pos << 1 | 1


def _up(cell: np.ndarray, level: np.ndarray) -> np.ndarray:
    bit = np.int64(1) << (2 * (fixed.MAX_LEVEL - np.clip(level, 0, 30))).astype(np.int64)
    return cell & -bit | bit


def _square(cell: np.ndarray) -> tuple[np.ndarray, ...]:
    """Face, low corner and size in leaf units."""
    bits = cell.view(np.uint64)
    f = (bits >> np.uint64(61)).astype(np.int64)
    pos = ((bits & np.uint64((1 << 61) - 1)) >> np.uint64(1)).astype(np.int64)
    lsb = bits & (~bits + np.uint64(1))
    size = np.int64(1) << (np.bitwise_count(lsb - np.uint64(1)) // 2).astype(np.int64)
    turn, i, j = f & 1, np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
    for k in range(56, -1, -4):
        turn = _POS[(turn & 3) << 4 | pos >> k & 15]
        i, j = i << 2 | turn >> 4, j << 2 | turn >> 2 & 3
    return np.minimum(f, 5), i & -size, j & -size, size


def _uv(s: np.ndarray) -> np.ndarray:
    return np.where(s >= 0.5, (1 / 3) * (4 * s * s - 1), (1 / 3) * (1 - 4 * (1 - s) * (1 - s)))


def _xyz(f: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    one = np.ones_like(u)
    out = np.stack([np.choose(f, [one, -u, -u, -one, v, v]), np.choose(f, [u, one, -v, -v, -one, u]), np.choose(f, [v, v, one, -u, -u, -one])])
    return out / np.sqrt((out * out).sum(axis=0))


def _center(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    f, i, j, size = _square(cell)
    return f, _xyz(f, _uv((2 * i + size) / (2 * _SIDE)), _uv((2 * j + size) / (2 * _SIDE)))


def _corners(cell: np.ndarray) -> tuple[np.ndarray, ...]:
    f, i, j, size = _square(cell)
    return f, size, _uv(i / _SIDE), _uv((i + size) / _SIDE), _uv(j / _SIDE), _uv((j + size) / _SIDE)


def _points(f: np.ndarray, at: np.ndarray) -> list[str]:
    x, y, z = at
    lon = np.where((y == 0) & ((f == 2) | (f == 3)), np.where(x <= 0, -180.0, -0.0), np.degrees(np.arctan2(y + 0.0, x)))
    lat = np.where((z == 0) & ((f == 3) | (f == 4)), -0.0, np.degrees(np.arctan2(z + 0.0, np.sqrt(x * x + y * y))))
    return [f"POINT({a:.7f} {b:.7f})" for a, b in zip(lon.tolist(), lat.tolist())]


@F.arrow_udf(T.LongType())
def s2_cell_id(lat: pa.Array, lon: pa.Array, level: pa.Array) -> pa.Array:
    depth = _numbers(level, np.int64)
    known = _known(lat, lon, level) & (depth >= 0) & (depth <= fixed.MAX_LEVEL)
    return pa.array(_up(_leaf(_numbers(lat, float), _numbers(lon, float)), depth), mask=~known)


@F.arrow_udf(T.BooleanType())
def s2_contains(cell: pa.Array, lat: pa.Array, lon: pa.Array) -> pa.Array:
    f, _, u0, u1, v0, v1 = _corners(_numbers(cell.fill_null(1), np.int64))
    d, p, q = _axes(f, *_direction(_numbers(lat, float), _numbers(lon, float)))
    e, front = fixed.UV_MARGIN, d > 0
    u, v = (n / np.where(front, d, 1) for n in (p, q))
    return pa.array(front & (u0 - e <= u) & (u <= u1 + e) & (v0 - e <= v) & (v <= v1 + e), mask=~_known(cell, lat, lon))


@F.arrow_udf(T.DoubleType())
def s2_distance_meters(cell1: pa.Array, cell2: pa.Array) -> pa.Array:
    a, b = (_center(_numbers(c.fill_null(1), np.int64))[1] for c in (cell1, cell2))
    far = np.arccos(np.clip((a * b).sum(axis=0), -1, 1)) * fixed.EARTH_RADIUS_M
    return pa.array(far, mask=~_known(cell1, cell2))


@F.arrow_udf(T.DoubleType())
def s2_area_m2(cell: pa.Array, level: pa.Array) -> pa.Array:
    depth = _numbers(level, np.int64)
    area = _areas(_up(_numbers(cell.fill_null(1), np.int64), depth))
    known = _known(cell, level) & (depth >= 0) & (depth <= fixed.MAX_LEVEL)
    return pa.array(area, mask=~known)


def _areas(cell: np.ndarray) -> np.ndarray:
    """Square meters of valid cells."""
    f, size, u0, u1, v0, v1 = _corners(cell)
    a, b, c, d = (_xyz(f, u, v) for u, v in ((u0, v0), (u1, v0), (u1, v1), (u0, v1)))
    flat = 0.5 * np.sqrt((np.cross(c - a, d - b, axis=0) ** 2).sum(axis=0))
    area = flat * 2 / (1 + np.sqrt(1 - np.minimum(flat / np.pi, 1)))
    area = np.where(size == _SIDE, 4 * np.pi / 6, np.where(size == _SIDE // 2, 4 * np.pi / 24, area))
    return area * (fixed.EARTH_RADIUS_M * fixed.EARTH_RADIUS_M)


def _cells_of(blob: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row of each cell of a column of union blobs, and the cell."""
    whole = blob.fill_null(b"").cast(pa.large_binary())
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    size = np.diff(at)
    some = np.flatnonzero(size >= 12)
    head = data[at[some][:, None] + np.arange(4)].view("<u4")[:, 0].astype(np.int64)
    count = np.minimum(head, (size[some] - 4) // 8)
    place = np.repeat(at[some] + 4, count) + 8 * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    return np.repeat(some, count), data[place[:, None] + np.arange(8)].view("<i8")[:, 0].astype(np.int64)


@F.arrow_udf(T.DoubleType())
def s2_cell_union_area(blob: pa.Array) -> pa.Array:
    """The areas of each blob's cells added up, copies each time; ids that are no cells count nothing."""
    owner, cell = _cells_of(blob)
    bits = cell.view(np.uint64)
    lsb = bits & (~bits + np.uint64(1))
    valid = (lsb > 0) & (np.bitwise_count(lsb - np.uint64(1)) % 2 == 0) & (lsb <= np.uint64(1 << 60)) & (bits >> np.uint64(61) < 6)
    area = np.where(valid, _areas(np.where(valid, cell, 1)), 0.0)
    return pa.array(np.bincount(owner, area, len(blob)), mask=~_known(blob))


def _ranges_of(blob: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last leaf of each cell of a column of union blobs."""
    owner, cell = _cells_of(blob)
    owner, cell = owner[cell != 0], cell[cell != 0]
    reach = np.where(cell == np.iinfo(np.int64).min, 1, cell & -cell) - 1
    return owner, cell - reach, cell + reach


@F.arrow_udf(T.BooleanType())
def s2_cell_union_intersects(blob1: pa.Array, blob2: pa.Array) -> pa.Array:
    """Whether any cells of two blobs overlap: one sweep over the starts of one side and the ends of the other.

    An end of the right side overlaps if the ranges of its row that start at or before it reach as far as its own start.
    """
    owner, lo, hi = _ranges_of(blob1)
    order = np.lexsort((lo, owner))
    owner, lo, hi = owner[order], lo[order], hi[order]
    by_end = np.lexsort((hi, owner))
    rank = np.empty(len(hi), np.int64)
    rank[by_end] = np.arange(len(hi))
    reach = hi[by_end[np.maximum.accumulate(rank)]] if len(hi) else hi  # ranks of later rows are greater
    other, start, end = _ranges_of(blob2)
    right = np.r_[np.zeros(len(lo), bool), np.ones(len(end), bool)]
    order = np.lexsort((right, np.r_[lo, end], np.r_[owner, other]))
    before = np.cumsum(~right[order]) - 1  # the last left range so far
    at = np.flatnonzero(right[order])
    asked, last = order[at] - len(lo), before[at]
    asked, last = asked[last >= 0], last[last >= 0]
    met = np.zeros(len(blob1), bool)
    met[other[asked[(owner[last] == other[asked]) & (reach[last] >= start[asked])]]] = True
    return pa.array(met, mask=~_known(blob1, blob2))


@F.arrow_udf(T.StringType())
def s2_to_geo(cell: pa.Array) -> pa.Array:
    return pa.array(_points(*_center(_numbers(cell.fill_null(1), np.int64))), pa.string(), mask=~_known(cell))


@F.arrow_udf(T.StringType())
def s2_cell_vertex(cell: pa.Array, k: pa.Array) -> pa.Array:
    n = _numbers(k, np.int64)
    f, _, u0, u1, v0, v1 = _corners(_numbers(cell.fill_null(1), np.int64))
    at = _xyz(f, np.where((n == 1) | (n == 2), u1, u0), np.where((n == 2) | (n == 3), v1, v0))
    texts = [t if 0 <= i <= 3 else "" for t, i in zip(_points(f, at), n.tolist())]
    return pa.array(texts, pa.string(), mask=~_known(cell, k))


_ALL = (s2_cell_id, s2_contains, s2_distance_meters, s2_area_m2, s2_to_geo, s2_cell_vertex, s2_cell_union_area, s2_cell_union_intersects)
BY_NAME = {f.func.__name__: f for f in _ALL}
