"""Cells over latitude/longitude rectangles, for a whole Arrow batch of rectangles at once.

Works level by level from the six faces: all rectangles of a batch advance
together as numpy arrays.  Within a level, cells with fewer children, then with
fewer finished children, are split first, as long as the cell budget allows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ..functions.fixed import MAX_LEVEL, ij_table

_TABLE = np.array(ij_table(), dtype=np.int64)
_SIDE = 1 << MAX_LEVEL
_EPS = 2.0**-52
# A rectangle whose forced cells exceed this is handed back unfinished (below its minimum level).
FORCED_LIMIT = 4096


def _wrap(angle):
    return (angle + np.pi) % (2 * np.pi) - np.pi


def _xyz(lat, lng):
    return np.stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)], axis=-1)


@dataclass
class Rects:
    lat_lo: np.ndarray
    lat_hi: np.ndarray
    mid: np.ndarray  # longitude of the center
    half: np.ndarray  # half of the longitude extent, pi when full

    @classmethod
    def of_degrees(cls, lat_lo, lat_hi, lon_lo, lon_hi) -> Rects:
        lo, hi = (np.radians(np.clip(np.asarray(v, float), -90, 90)) for v in (lat_lo, lat_hi))
        west, east = (np.radians(np.asarray(v, float)) for v in (lon_lo, lon_hi))
        return cls(lo, hi, _wrap((west + east) / 2), np.minimum((east - west) / 2, np.pi))

    def take(self, k) -> Rects:
        return Rects(self.lat_lo[k], self.lat_hi[k], self.mid[k], self.half[k])

    def has_lng(self, lng):
        return np.abs(_wrap(lng - self.mid)) <= self.half

    def has(self, lat, lng):
        return (self.lat_lo <= lat) & (lat <= self.lat_hi) & self.has_lng(lng)


class Cells:
    """Squares of one level: face and low corner in leaf units."""

    def __init__(self, f, i, j, level):
        self.f, self.i, self.j, self.level = f, i, j, level

    def take(self, k) -> Cells:
        return Cells(self.f[k], self.i[k], self.j[k], self.level)

    def children(self) -> Cells:
        half = _SIDE >> (self.level + 1)
        step = np.array([0, 0, 1, 1]) * half, np.array([0, 1, 0, 1]) * half
        i = (self.i[:, None] + step[0]).ravel()
        j = (self.j[:, None] + step[1]).ravel()
        return Cells(np.repeat(self.f, 4), i, j, self.level + 1)

    def ids(self) -> np.ndarray:
        acc = self.f & 1
        for shift in range(28, -1, -2):
            index = (acc & 3) * 16 + ((self.i >> shift) & 3) * 4 + ((self.j >> shift) & 3)
            acc = ((acc & -4) << 4) | _TABLE[index]
        leaf = (self.f.astype(np.uint64) << np.uint64(61)).astype(np.int64) | ((acc >> 2) << 1) | 1
        bit = np.int64(1) << np.int64(2 * (MAX_LEVEL - self.level))
        return (leaf & -bit) | bit

    def uv(self):
        size = _SIDE >> self.level

        def project(n):
            s = n / _SIDE
            return np.where(s >= 0.5, (4 * s * s - 1) / 3, (1 - 4 * (1 - s) ** 2) / 3)

        return project(self.i), project(self.i + size), project(self.j), project(self.j + size), project(
            self.i + size / 2
        ), project(self.j + size / 2)

    def points(self):
        """Corners (n, 4, 3) and center (n, 3), unit length."""
        u0, u1, v0, v1, uc, vc = self.uv()
        u = np.stack([u0, u1, u1, u0, uc], axis=1)
        v = np.stack([v0, v0, v1, v1, vc], axis=1)
        one = np.ones_like(u)
        x, y, z = (
            np.choose(self.f[:, None], c)
            for c in ((one, -u, -u, -one, v, v), (u, one, -v, -v, -one, u), (v, v, one, -u, -u, -one))
        )
        p = np.stack([x, y, z], axis=-1)
        p /= np.linalg.norm(p, axis=-1, keepdims=True)
        return p[:, :4], p[:, 4]

    def bounds(self, corners, center):
        """Latitude range, longitude middle and half extent."""
        if self.level == 0:
            top = np.arcsin(np.sqrt(1 / 3))
            polar = (self.f % 3) == 2
            lo = np.choose(self.f, [-np.pi / 4, -np.pi / 4, top, -np.pi / 4, -np.pi / 4, -np.pi / 2])
            hi = np.choose(self.f, [np.pi / 4, np.pi / 4, np.pi / 2, np.pi / 4, np.pi / 4, -top])
            mid = np.choose(self.f, [0, np.pi / 2, 0, np.pi, -np.pi / 2, 0])
            return lo, hi, mid, np.where(polar, np.pi, np.pi / 4)
        lat = np.arctan2(corners[..., 2], np.hypot(corners[..., 0], corners[..., 1]))
        lng = np.arctan2(corners[..., 1], corners[..., 0])
        mid = np.arctan2(center[:, 1], center[:, 0])
        off = _wrap(lng - mid[:, None])
        polar = np.abs(lat).max(axis=1) > np.pi / 2 - 1e-14
        west, east = off.min(axis=1), off.max(axis=1)
        half = np.where(polar, np.pi, (east - west) / 2 + 2 * _EPS)
        return lat.min(axis=1) - 2 * _EPS, lat.max(axis=1) + 2 * _EPS, _wrap(mid + (east + west) / 2), half

    def has(self, p):
        """Whether points (n, 3) lie in the squares."""
        u0, u1, v0, v1, _, _ = self.uv()
        x, y, z = p[:, 0], p[:, 1], p[:, 2]
        d = np.choose(self.f, [x, y, z, -x, -y, -z])
        safe = np.where(d > 0, d, 1)
        u = np.choose(self.f, [y, -x, -x, -z, -z, y]) / safe
        v = np.choose(self.f, [z, z, -y, -y, x, x]) / safe
        return (d > 0) & (u0 - _EPS <= u) & (u <= u1 + _EPS) & (v0 - _EPS <= v) & (v <= v1 + _EPS)


def relate(rects: Rects, cells: Cells):
    """Per row: does the rectangle meet the cell, does it hold the whole cell."""
    corners, center = cells.points()
    lo, hi, mid, half = cells.bounds(corners, center)
    gap = np.abs(_wrap(mid - rects.mid))
    # parallels may be cut by an edge's bulge: the bound of corners is exact for cells below faces
    apart = (lo > rects.lat_hi) | (hi < rects.lat_lo) | (gap > half + rects.half)
    full = rects.half >= np.pi
    inside = (rects.lat_lo <= lo) & (hi <= rects.lat_hi) & (full | (gap + half <= rects.half))

    lat = np.arctan2(corners[..., 2], np.hypot(corners[..., 0], corners[..., 1]))
    lng = np.arctan2(corners[..., 1], corners[..., 0])
    meets = rects.has(np.arctan2(center[:, 2], np.hypot(center[:, 0], center[:, 1])), np.arctan2(center[:, 1], center[:, 0]))
    for k in range(4):
        meets |= rects.has(lat[:, k], lng[:, k])
    meets |= cells.has(_xyz((rects.lat_lo + rects.lat_hi) / 2, rects.mid))
    for side in (rects.lat_lo, rects.lat_hi):
        for sign in (-1, 1):
            meets |= cells.has(_xyz(side, rects.mid + sign * rects.half))
    open_rows = np.flatnonzero(~meets & ~apart)
    if len(open_rows):
        r, c = rects.take(open_rows), corners[open_rows]
        crossed = np.zeros(len(open_rows), bool)
        for k in range(4):
            a, b = c[:, k], c[:, (k + 1) % 4]
            for sign in (-1, 1):
                crossed |= (r.half < np.pi) & _crosses_meridian(a, b, r, r.mid + sign * r.half)
            for side in (r.lat_lo, r.lat_hi):
                crossed |= _crosses_parallel(a, b, r, side)
        meets[open_rows] = crossed
    return meets & ~apart, inside


def _dot(a, b):
    return np.einsum("ij,ij->i", a, b)


def _crosses_meridian(a, b, r: Rects, lng):
    c, d = _xyz(r.lat_lo, lng), _xyz(r.lat_hi, lng)
    ab, cd = np.cross(a, b), np.cross(c, d)
    acb, bda = -_dot(ab, c), _dot(ab, d)
    cbd, dac = -_dot(cd, b), _dot(cd, a)
    return (acb * bda > 0) & (acb * cbd > 0) & (acb * dac > 0)


def _crosses_parallel(a, b, r: Rects, lat):
    """An edge against a side of constant latitude, solved in the plane of the edge."""
    z = np.cross(a, b)
    z = np.where(z[:, 2:] < 0, -z, z)
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    y = np.cross(z, np.array([0.0, 0.0, 1.0]))
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    x = np.cross(y, z)
    reach = np.sin(lat)
    able = np.abs(reach) < x[:, 2]
    cos_t = np.where(able, reach / np.where(able, x[:, 2], 1), 0)
    theta = np.arctan2(np.sqrt(np.maximum(1 - cos_t**2, 0)), cos_t)
    start, stop = np.arctan2(_dot(a, y), _dot(a, x)), np.arctan2(_dot(b, y), _dot(b, x))
    middle, reach_half = start + _wrap(stop - start) / 2, np.abs(_wrap(stop - start)) / 2
    hit = np.zeros(len(a), bool)
    for t in (theta, -theta):
        p = x * np.cos(t)[:, None] + y * np.sin(t)[:, None]
        on_edge = np.abs(_wrap(t - middle)) <= reach_half
        hit |= able & on_edge & r.has_lng(np.arctan2(p[:, 1], p[:, 0]))
    return hit


def _before(owner, amount):
    """Running sum within each (sorted) owner, before the row itself."""
    total = np.cumsum(amount) - amount
    starts = np.r_[True, owner[1:] != owner[:-1]]
    return total - np.maximum.accumulate(np.where(starts, total, np.iinfo(np.int64).min))


def cover(rects: Rects, min_level, max_level, max_cells, interior: bool):
    """(owner, id) arrays of a covering, or of cells wholly inside, for every rectangle."""
    n = len(rects.mid)
    levels_lo = np.clip(np.asarray(min_level), 0, MAX_LEVEL)
    levels_hi = np.clip(np.asarray(max_level), 0, MAX_LEVEL)
    budget = np.asarray(max_cells)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    count = np.zeros(n, np.int64)

    def judge(owner, cells):
        meets, inside = relate(rects.take(owner), cells)
        ready = levels_lo[owner] <= cells.level
        last = levels_hi[owner] <= cells.level
        if interior:
            return meets & ~(ready & last & ~inside), ready & inside, inside
        return meets, ready & (inside | last), inside

    def settle(owner, cells):
        found.append((owner, cells.ids()))
        np.add.at(count, owner, 1)

    owner = np.repeat(np.arange(n), 6)
    cells = Cells(np.tile(np.arange(6), n), np.zeros(6 * n, np.int64), np.zeros(6 * n, np.int64), 0)
    alive, done, inside = judge(owner, cells)
    while True:
        owner, cells, done, inside = owner[alive], cells.take(alive), done[alive], inside[alive]
        if interior and len(owner):
            # enough cells inside are on hand: of those still to be split, keep as many as the budget
            order = np.lexsort((cells.ids().view(np.uint64), ~inside, owner))
            owner, cells, done, inside = owner[order], cells.take(order), done[order], inside[order]
            keep = ~inside | done | (_before(owner, inside & ~done) < budget[owner])
            # with a budget of cells inside on hand, the boundary can add nothing
            on_hand = count + np.bincount(owner, inside, n)
            keep &= inside | (on_hand[owner] < budget[owner])
            room = ~done | (count[owner] + _before(owner, done.astype(np.int64)) < budget[owner])
            owner, cells, done, inside = (
                owner[keep & room], cells.take(keep & room), done[keep & room], inside[keep & room]
            )
        settle(owner[done], cells.take(done))
        owner, cells = owner[~done], cells.take(~done)
        if interior:
            short = count[owner] < budget[owner]
            owner, cells = owner[short], cells.take(short)
        elif len(owner):
            forced = levels_lo[owner] > cells.level
            size = np.bincount(owner[forced], minlength=n)
            large = forced & (size[owner] > FORCED_LIMIT)
            settle(owner[large], cells.take(large))
            owner, cells = owner[~large], cells.take(~large)
        if not len(owner):
            break
        kids, kid_owner = cells.children(), np.repeat(owner, 4)
        kid_alive, kid_done, kid_inside = judge(kid_owner, kids)
        per = kid_alive.reshape(-1, 4).sum(axis=1)
        finished = (kid_alive & kid_done).reshape(-1, 4).sum(axis=1)
        split = per > 0
        if not interior:
            whole = (finished == 4) & (levels_lo[owner] <= cells.level)
            settle(owner[whole], cells.take(whole))
            split &= ~whole
            rows = np.flatnonzero(split)
            rows = rows[np.lexsort((cells.take(rows).ids().view(np.uint64), finished[rows], per[rows], owner[rows]))]
            own, c = owner[rows], per[rows]
            total = count[own] + np.bincount(own, minlength=n)[own] + _before(own, c - 1) + c - 1
            grow = (levels_lo[own] > cells.level) | (c == 1) | (total <= budget[own])
            settle(own[~grow], cells.take(rows[~grow]))
            split[rows[~grow]] = False
        kid_alive &= np.repeat(split, 4)
        owner, cells, alive, done, inside = kid_owner, kids, kid_alive, kid_done, kid_inside
    owner = np.concatenate([o for o, _ in found])
    return merge_siblings(owner, np.concatenate([i for _, i in found]))


def lsb(ids):
    return ids & -ids


def _in_order(owner, ids):
    order = np.lexsort((ids.view(np.uint64), owner))
    return owner[order], ids[order]


def normalize(owner, ids):
    """Sorted in cell order per owner, without copies and nested cells, four siblings merged."""
    owner, ids = _in_order(owner, ids)
    keep = np.r_[True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])][: len(ids)]
    owner, ids = owner[keep], ids[keep]
    present = sorted(set(lsb(ids).tolist()))
    for bit in present[1:]:
        at = lsb(ids) == bit
        up = (ids & -bit) | bit
        held = np.isin(np.rec.fromarrays([owner, up]), np.rec.fromarrays([owner[at], ids[at]]))
        keep = ~(held & (lsb(ids) < bit))
        owner, ids = owner[keep], ids[keep]
    return merge_siblings(owner, ids)


def merge_siblings(owner, ids):
    """Four siblings -> their parent, from the finest level up; cells are disjoint, result in cell order."""
    owner, ids = _in_order(owner, ids)
    for level in range(MAX_LEVEL, 0, -1):
        bit = np.int64(1) << np.int64(2 * (MAX_LEVEL - level))
        at = np.flatnonzero(lsb(ids) == bit)
        if len(at) < 4:
            continue
        up = (ids[at] & -(bit << 2)) | (bit << 2)
        # in cell order siblings follow each other
        first = np.flatnonzero((up[:-3] == up[3:]) & (owner[at[:-3]] == owner[at[3:]]))
        if len(first):
            ids[at[first]] = up[first]
            gone = np.concatenate([at[first + k] for k in (1, 2, 3)])
            owner, ids = _in_order(np.delete(owner, gone), np.delete(ids, gone))
    return owner, ids
