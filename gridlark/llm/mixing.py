"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size takes each document floor(r) or floor(r) + 1 times.  The fractional parts are
rounded by pivotal steps weighted with the documents' sizes: two documents exchange words until one of them is taken
whole or not at all, at random in such a way that every document keeps its probability.  A step keeps the words taken
together, so a source misses its target by less than its largest document.

The steps form a reduction tree: rows of a source are dealt to groups by a hash; each group ends with at most one
undecided document, and these residuals meet in groups again until one is left, which is rounded by itself.  Groups have
about ``GROUP`` rows whatever the source's size.  Chance comes from hashes of ids and a seed, so runs agree.

Sources rank by code point with null last.  Targets are shares of the budget by weight; a source stops at ``most`` times
its size and its excess goes to the others by weight, until none is above: targets are min(most * size, level * weight)
for the level that spends the budget.  A null text has size 0, like any text without words; such documents are taken
floor(r) times and count no words.  Repeated rows are documents of their own.  A null id is an id like others.  An empty
table gives an empty result.  The input's own columns stay, unless new ones have their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import common

# Rows that one step of the tree rounds together, about.
GROUP = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, source_size), a row per source: adds rank and target.

    Sources sort by the level at which they stop; prefix sums tell for each how much is spent at that level.
    """
    cycle = ", ".join(f"{w}D" for w in weights)
    ranked = sizes.selectExpr("*", "row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank")
    ranked = ranked.selectExpr(
        "*", f"element_at(array({cycle}), CAST(rank % {len(weights)} AS INT) + 1) AS _weight",
        f"source_size * {most}D AS _cap", f"sum(source_size) OVER () * {share}D AS _budget",
    )
    order = "OVER (ORDER BY _cap / _weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    spent = ranked.selectExpr(
        "*", f"sum(_cap) {order} AS _stopped", f"sum(_weight) OVER () - sum(_weight) {order} AS _rest"
    )
    # all up to a source stop if the budget lasts while the others stand at the same level
    full = spent.withColumn("_full", F.expr("_stopped + _rest * (_cap / _weight) <= _budget"))
    level = full.selectExpr(
        "*",
        "coalesce(max(if(_full, _stopped, 0D)) OVER (), 0D) AS _gone",
        "sum(if(_full, 0D, _weight)) OVER () AS _open",
    )
    return level.selectExpr(
        *(f"`{c}`" for c in sizes.columns), "rank",
        "if(_full, _cap, try_divide(_budget - _gone, _open) * _weight) AS target",
    )


def _uniform(ids: np.ndarray, level: int, seed: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit ids."""
    x = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + level * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return ((x ^ x >> np.uint64(31)) >> np.uint64(11)) / float(1 << 53)


def _snap(p: float) -> float:
    """0 or 1 where only an error of the arithmetic keeps it from that."""
    return 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p


def pivot(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Rounds probabilities one after the other, in words; all but at most one end as 0 or 1.

    The undecided document i (p_i of its words) meets the next j.  Moving words from j to i or from i to j until one of
    the two is at 0 or 1 takes d and e words; the first happens with probability e / (d + e), so neither's mean changes.
    """
    out = p.tolist()
    sizes, chance = size.tolist(), u.tolist()
    i = -1
    for j, pj in enumerate(out):
        if not 0 < pj < 1:
            continue
        if i < 0:
            i = j
            continue
        pi, a, b = out[i], sizes[i], sizes[j]
        d = min((1 - pi) * a, pj * b)  # from j to i
        e = min(pi * a, (1 - pj) * b)  # from i to j
        if chance[j] * (d + e) < e:
            out[i], out[j] = (1.0, _snap(pj - d / b)) if (1 - pi) * a <= pj * b else (_snap(pi + d / a), 0.0)
        else:
            out[i], out[j] = (0.0, _snap(pj + e / b)) if pi * a <= (1 - pj) * b else (_snap(pi - e / a), 1.0)
        if not 0 < out[i] < 1:
            i = j if 0 < out[j] < 1 else -1
    return np.array(out, float)


def _round(level: int, seed: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("_key", "ascending")])
        u = _uniform(table["_key"].to_numpy(), level, seed)
        p = pivot(table["_p"].to_numpy(), table["size"].to_numpy(), u)
        if last:
            p = np.where((p > 0) & (p < 1), _uniform(table["_key"].to_numpy(), level + 1, seed) < p, p)
        table = table.set_column(table.schema.get_field_index("_p"), "_p", pa.array(p, pa.float64()))
        return table.select(["_source", "size", "_key", "_p"])

    return run


def _rounded(rows: DataFrame, seed: int, group: int) -> DataFrame:
    """``rows`` (_source, size, _key, _p) with all _p at 0 or 1, through levels of groups."""
    schema = "_source string, size long, _key long, _p double"
    undecided, out, level = rows, rows.where("false"), 0
    while True:
        counts = undecided.groupBy("_source").agg(F.ceil(F.count("*") / group).cast("int").alias("_groups"))
        most = counts.agg(F.max("_groups")).first()[0]
        if most is None:
            return out
        dealt = common.lookup(undecided, counts, "_source")
        dealt = dealt.withColumn("_group", F.pmod(F.xxhash64("_key", F.lit(level)), F.col("_groups")))
        # a hot source has as many groups as its rows need
        done = dealt.groupBy("_source", "_group").applyInArrow(
            _round(level, seed, most == 1), schema
        )
        done = stored(done)
        out = out.union(done.where("_p = 0 OR _p = 1"))
        undecided, level = done.where("_p > 0 AND _p < 1"), level + 1


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(common.WORD)).cast("bigint")


OWN = ["size", "source_size", "target", "copies", "taken"]


def measured(df: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """``df`` with size, _source (a text for each source, null's too) and _key (equal for equal documents)."""
    kept = [c for c in df.columns if c.lower() not in [*OWN, "_source", "_key"]]
    body, kind = common.text_of(df, text), df[f"`{source}`"].cast("string")
    return df.select(
        *(df[f"`{c}`"] for c in kept), word_count(body).alias("size"),
        F.coalesce(F.concat(F.lit("="), kind), F.lit("")).alias("_source"),
        F.xxhash64(df[f"`{doc_id}`"], kind, F.xxhash64(body)).alias("_key"),
    )


def decided(
    rows: DataFrame, seed: int = 0, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
    group: int = GROUP,
) -> DataFrame:
    """For each _key of ``measured`` rows: source_size, target, how often all its rows are taken, and how many once more."""
    # equal documents move as one row and are told apart by their number
    small = stored(rows.groupBy("_source", "size", "_key").agg(F.count("*").alias("_n")))
    sizes = small.groupBy("_source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    named = sizes.select("*", F.when(F.col("_source") != "", F.substring("_source", 2, 1 << 30)).alias("source"))
    goals = targets(named, weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = stored(goals.withColumn("_whole", F.floor(ratio)).withColumn("_p", ratio - F.col("_whole")))
    goals = goals.select("_source", "source_size", "target", "_whole", "_p")
    aimed = stored(common.lookup(small, goals, "_source"))
    each = aimed.where("_p > 0 AND size > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    apart = F.when(F.col("_copy") == 1, F.col("_key")).otherwise(F.xxhash64("_key", "_copy"))
    spread = each.select("_source", "size", apart.alias("_apart"), "_p", F.col("_key").alias("_of"))
    spread = stored(spread)
    chosen = _rounded(spread.select("_source", "size", F.col("_apart").alias("_key"), "_p"), seed, group)
    up = chosen.where("_p = 1").select(F.col("_key").alias("_apart"))
    ups = spread.join(up, "_apart", "left_semi").groupBy(F.col("_of").alias("_key")).agg(F.count("*").alias("_ups"))
    return aimed.join(ups, "_key", "left").select(
        "_key", "source_size", "target", "_whole", F.coalesce("_ups", F.lit(0)).alias("_ups"), "_n"
    )


def applied(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """``measured`` rows with source_size, target, copies and taken."""
    decisions = stored(decisions)
    partly = F.expr("_ups > 0 AND _ups < _n")
    joined = common.lookup(rows, decisions, "_key", hot=decisions.select("_key", "_n"))
    copies = F.col("_whole") + F.when(F.col("_ups") >= F.col("_n"), 1).otherwise(0)
    if not decisions.where(partly).isEmpty():
        # of equal rows, some are taken once more
        some = joined.where(partly).withColumn("_at", F.monotonically_increasing_id())
        place = F.expr("row_number() OVER (PARTITION BY _key ORDER BY _at)")
        some = some.withColumn("_place", place).withColumn("copies", F.expr("_whole + if(_place <= _ups, 1, 0)"))
        some = some.drop("_at", "_place")
        out = joined.where(~partly).withColumn("copies", copies).unionByName(some)
    else:
        out = joined.withColumn("copies", copies)
    out = out.withColumn("copies", F.col("copies").cast("int")).withColumn("taken", F.col("copies") * F.col("size"))
    kept = [c for c in rows.columns if c not in ("size", "_source", "_key")]
    return out.select(*kept, *OWN)


def mixed(df: DataFrame, doc_id: str, source: str, text: str, seed: int = 0, **options) -> DataFrame:
    """``df`` with size, source_size, target, copies and taken (words) of each row."""
    rows = measured(df, doc_id, source, text)
    return applied(rows, decided(rows, seed, **options))


def taken(df: DataFrame, doc_id: str, source: str, text: str, seed: int = 0, **options) -> DataFrame:
    """The mix: each row of ``df``, with its own columns, as often as it is taken."""
    named = {"doc_id": doc_id, "source": source, "text": text}
    row = F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("_row")
    whole = df.select(row, *(df[f"`{c}`"].alias(name) for name, c in named.items()))
    rows = measured(whole, *named).drop(*named)
    mix = applied(rows, decided(rows, seed, **options)).where("copies > 0")
    return mix.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
