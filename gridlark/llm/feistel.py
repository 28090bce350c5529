"""Sharding by a Feistel permutation of global row numbers.

Rows get a number (0 to N - 1) in ascending order of their id; a keyed permutation of these numbers gives each row its
place in a reproducible shuffle.  Place p is slot p div S of shard p mod S, so shards differ by one row at most, slots
have no gaps, and shard and slot of any row (or the row at any shard and slot) are computed from N, S and the seed alone.

The permutation works on pairs of digits in base m, the least m with m * m >= N: each round replaces (l, r) by
(r, l + F(r) mod m), where F squares a linear function of r modulo a prime.  Results from N on are sent through again
(cycle walking) until they fall below N.

A null id counts as least, a null text as empty.  Rows with equal ids are ordered by a hash of their texts and then as
they come (equal rows have equal results, in whatever order).  An empty table gives an empty result.  Other columns of
the input are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import common

ROUNDS = 6
# A prime below 2 ** 31, so that products of residues fit 63 bits.
PRIME = (1 << 31) - 1
# Results that are walked in one expression.  Fewer than 2 * sqrt(N) + 1 numbers lie outside, so for small N no walk
# is longer, and for N > 1000 a longer one has odds of less than 1e-70; it raises an error.
WALK = 64


def _base(n: int) -> int:
    return isqrt(max(n - 1, 0)) + 1


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Factor and summand of each round, from a seed."""
    out, state = [], seed % PRIME
    for _ in range(2 * ROUNDS + 4):
        state = (state * 48271 + 11) % PRIME  # a minimal standard generator
        out.append(state)
    return [(out[4 + 2 * i] | 1, out[5 + 2 * i]) for i in range(ROUNDS)]


def _once(x: str, m: int, seed: int, back: bool) -> str:
    line = f"(({'s.l' if back else 's.r'} * k.a + k.b) % {PRIME}L)"  # digits are below 2 ** 31 for up to 2 ** 62 rows
    f = f"(({line} * {line}) % {PRIME}L % {m}L)"
    step = f"named_struct('l', pmod(s.r - {f}, {m}L), 'r', s.l)" if back else f"named_struct('l', s.r, 'r', pmod(s.l + {f}, {m}L))"
    keys = round_keys(seed)[:: -1 if back else 1]
    rounds = ", ".join(f"named_struct('a', {a}L, 'b', {b}L)" for a, b in keys)
    start = f"named_struct('l', {x} div {m}L, 'r', {x} % {m}L)"
    return f"aggregate(array({rounds}), {start}, (s, k) -> {step}, s -> s.l * {m}L + s.r)"


def permuted(x: str, n: int, seed: int, back: bool = False) -> str:
    """SQL of the place of row number ``x`` among ``n`` (``back``: of the row number at place ``x``)."""
    m = _base(n)
    walk = f"aggregate(sequence(1, {WALK}), {_once(x, m, seed, back)}, (w, i) -> if(w < {n}L, w, {_once('w', m, seed, back)}))"
    return f"transform(array({walk}), w -> if(w < {n}L, w, raise_error('a walk of over {WALK} steps')))[0]"


def shards(df: DataFrame, doc_id: str, text: str, count: int, seed: int = 0) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 8), text_crc32, row, shard and slot of each row."""
    body = common.text_of(df, text)
    small = df.select(
        df[f"`{doc_id}`"].alias("doc_id"),
        (F.octet_length(body).cast("bigint") + 8).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_hash"),
    )
    ordered = stored(common.in_order(small, ["doc_id", "_hash", "size", "text_crc32"]))
    n = ordered.count()
    placed = common.numbered(ordered, number="row").withColumn("_place", F.expr(permuted("row", n, seed)))
    return placed.selectExpr(
        "doc_id", "size", "text_crc32", "row", f"CAST(_place % {count} AS INT) AS shard", f"_place div {count} AS slot"
    )
