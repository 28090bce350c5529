"""Merkle manifest of a table: a tree of digests over the rows of each group, and one over the groups.

*Digests.*  H is the lowercase hex SHA-256 of its inputs end to end, digests as their hex text.  A leaf is H of a row's
columns, each ``-`` if null, else the UTF-8 byte count, ``:`` and the value.  While a level has several nodes, every
``ARITY`` of them that follow each other (the last run may be shorter, even one) become their H.  What remains is the
group's subroot (a lone leaf itself); subroots in the order of the groups' names (null first, then bytewise) give the root
in the same way.

*Places without sorting.*  The ids of a group are a bitmap, kept as those of its 64-bit words that aren't zero.  Parts of a
bitmap merge by ``bit_or`` before they are shuffled.  Above the words stands a directory of counts per longer and longer
prefix of the id, each with the count before it among the at most 4096 children of its parent, so a prefix sum never runs
over a whole group.  An id's rank, the place of its leaf, is its word's count from the directory and the bits below it in
the word.  Only rows whose id is null or occurs more than once in its group are sorted, by id and leaf.

*Levels.*  Nodes are keyed by tree and by place.  ``BLOCK`` places form an array of slots, and a task reduces each array
through several levels at once; the arrays' roots are the nodes of the next round.  On the way back each array hands its
nodes' siblings down to the arrays below, so a row's proof (its siblings up to the root) comes with its array, and neither
a group nor a level meets in one task.

Null ids come first in their group.  Rows with equal ids follow each other by leaf digest; repeated rows have equal leaves
and a place each.  Null texts are ``-``, empty ones ``0:``.  An empty table gives an empty manifest.  Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from . import common

ARITY = 3
# Levels that an array of slots goes up at once, and its slots.
LEVELS = 5
BLOCK = ARITY**LEVELS
# Bits of a bitmap's words, and children of a prefix in the directory of counts.
WORD_BITS = 6
CHILDREN_BITS = 12

NODES = "tree string, index long, n long, hash binary"
PATHS = "name string, tree string, index long, path array<string>, subroot string, root string"
PROOFS = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


# --- leaves and their places -------------------------------------------------------------------------------------


def leaf(columns: list[Column]) -> Column:
    """The digest of a row, as 32 bytes."""
    fields = []
    for c in columns:
        value = c.cast("string")
        field = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(field, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*fields), 256))


def tree_of(group: Column) -> Column:
    """A group's name as a key that isn't null and keeps the order: null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


_KEYS = ["tree", "has", "word"]


def words(rows: DataFrame) -> DataFrame:
    """(tree, has, word, bits, n): the words of each tree's bitmap of ids, with the rows in each; null ids have none (has 0)."""
    bit = F.coalesce(F.expr("shiftleft(1L, CAST(id & 63 AS INT))"), F.lit(0))
    return rows.groupBy(*_own_word()).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n"))


def _own_word() -> list[Column]:
    word = F.coalesce(F.shiftright("id", WORD_BITS), F.lit(0)).alias("word")
    return [F.col("tree"), F.col("id").isNotNull().cast("int").alias("has"), word]


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``base``, the rows of the tree before the word, and ``total``, all rows of the tree.  Stored before."""
    levels, nodes, bits = [], words.select(*_KEYS, "n"), WORD_BITS
    while bits < 63:
        most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
        if most <= 1 << CHILDREN_BITS:
            break
        parent = F.shiftright("word", CHILDREN_BITS).alias("parent")
        among = Window.partitionBy("tree", "has", "parent").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
        nodes = nodes.select("*", parent).withColumn("before", F.coalesce(F.sum("n").over(among), F.lit(0)))
        nodes = stored(nodes)
        levels.append(nodes)
        nodes = stored(nodes.groupBy("tree", "has", F.col("parent").alias("word")).agg(F.sum("n").alias("n")))
        bits += CHILDREN_BITS
    top = Window.partitionBy("tree").orderBy("has", "word")  # few rows
    based = nodes.select(
        *_KEYS, F.coalesce(F.sum("n").over(top.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    for level in reversed(levels):
        above = based.withColumnRenamed("word", "parent")
        based = level.join(above, ["tree", "has", "parent"]).select(*_KEYS, (F.col("before") + F.col("base")).alias("base"), "total")
    return words.join(based, _KEYS)


def placed(rows: DataFrame) -> DataFrame:
    """Rows (tree, id, leaf, other) with ``index``, each leaf's place in its tree, and ``n``, the tree's leaves."""
    based = stored(directory(stored(words(rows))))
    each = rows.withColumns({c: w for c, w in zip(_KEYS[1:], _own_word()[1:])})
    sole = based.where("n = bit_count(bits)")
    out = each.join(sole.select(*_KEYS, "base", "total", "bits"), _KEYS).select(
        "tree", "id", "leaf", "other", F.expr("base + bit_count(bits & ~shiftleft(-1L, CAST(id & 63 AS INT)))").alias("index"),
        F.col("total").alias("n"),
    )
    if based.where("n <> bit_count(bits)").isEmpty():
        return out
    # words with ids that occur more than once, or without ids: equal rows as one, with their number
    shared = based.where("n <> bit_count(bits)").select(*_KEYS, "base", "total")
    equal = each.join(shared.select(*_KEYS), _KEYS, "left_semi").groupBy(*_KEYS, "id", "leaf", "other").agg(F.count("*").alias("_c"))
    ordered = stored(common.in_order(equal, [*_KEYS, "id", "leaf", "other"]).withColumn("_part", F.shiftright("_at", 33)))
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ordered = ordered.withColumn("_before", F.coalesce(F.sum("_c").over(within), F.lit(0)))
    before = "coalesce(sum(_c) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _base"
    bases = ordered.groupBy("_part").agg(F.sum("_c").alias("_c")).selectExpr("_part", before)  # a row for each partition
    ordered = stored(ordered.join(F.broadcast(bases), "_part").withColumn("_before", F.col("_before") + F.col("_base")))
    first = ordered.groupBy(*_KEYS).agg(F.min("_before").alias("_first"))
    own = ordered.join(shared.join(first, _KEYS), _KEYS).withColumn("_at", F.expr("base + _before - _first"))
    each = own.select("tree", "id", "leaf", "other", F.explode(F.expr("sequence(_at, _at + _c - 1)")).alias("index"), F.col("total").alias("n"))
    return out.unionByName(each)


# --- arrays of slots ---------------------------------------------------------------------------------------------


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of an array and of so many levels above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(*below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return out


def siblings(levels: list[list[str]]) -> list[list[str]]:
    """For each node of the lowest level: for each level up to the array's root what stands left and right in its run."""
    beside = []
    for level in levels[:-1]:
        runs = [level[i // ARITY * ARITY : i // ARITY * ARITY + ARITY] for i in range(len(level))]
        beside.append([("".join(run[: i % ARITY]), "".join(run[i % ARITY + 1 :])) for i, run in enumerate(runs)])
    return [[x for k, each in enumerate(beside) for x in each[i // ARITY**k]] for i in range(len(levels[0]))]


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(path[::2], path[1::2]):
        leaf = digest(left, leaf, right)
    return leaf


def _above(n: int) -> int:
    """Levels that an array goes up in a tree whose level has ``n`` nodes."""
    return min(LEVELS, levels_of(n))


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"tree": batch.column(0), "index": batch.column(1), "n": [], "hash": []}
        for n, slots in zip(batch.column(2).to_pylist(), batch.column(3)):
            nodes = [h.hex() for h in slots.values.field("hash").to_pylist()]
            out["hash"].append(bytes.fromhex(reduced(nodes, _above(n))[-1][0]))
            out["n"].append(-(-n // BLOCK))
        yield pa.RecordBatch.from_arrays([out["tree"], out["index"], pa.array(out["n"], pa.int64()), pa.array(out["hash"], pa.binary())], list(out))


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each array: its row, the slots, the nodes, and each slot's path to the root."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in ("tree", "block", "n", "slots", "path", "subroot", "root")}
            slots = row.pop("slots").values
            row = {k: v.as_py() for k, v in row.items()}
            nodes = [h.hex() for h in slots.field("hash").to_pylist()]
            paths = siblings(reduced(nodes, _above(row["n"])))
            yield row, slots, nodes, [own + row["path"] for own in paths]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, slots, nodes, paths in _down(batches):
        n = len(nodes)
        arrays = [
            slots.field("name").cast(pa.string()), pa.array([row["tree"]] * n, pa.string()),
            pa.array(range(row["block"] * BLOCK, row["block"] * BLOCK + n), pa.int64()), pa.array(paths, pa.list_(pa.string())),
            pa.array([row["subroot"]] * n, pa.string()), pa.array([row["root"]] * n, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["name", "tree", "index", "path", "subroot", "root"])


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, slots, nodes, paths in _down(batches):
        n, others = len(nodes), slots.field("other").to_pylist()
        start = [h if other is None else other.hex() for h, other in zip(nodes, others)]
        arrays = [
            slots.field("id").cast(pa.int64()), pa.array(nodes, pa.string()), pa.array([row["subroot"]] * n, pa.string()),
            pa.array([row["root"]] * n, pa.string()), pa.array([digest(*path) for path in paths], pa.string()),
            pa.array([folded(h, path) for h, path in zip(start, paths)], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, [f.split(" ")[0] for f in PROOFS.split(", ")])


def climbed(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The arrays of each round, and (tree, hash, round) of each tree's root.

    ``nodes``: tree, index, n, hash, and what the arrays keep of each: id, other, name.
    """
    rounds, roots = [], []
    while True:
        slot = F.struct(F.expr(f"CAST(index % {BLOCK} AS INT) AS slot"), "hash", "id", "other", "name")
        arrays = nodes.groupBy("tree", F.expr(f"index div {BLOCK} AS block"))
        arrays = stored(arrays.agg(F.max("n").alias("n"), F.array_sort(F.collect_list(slot)).alias("slots")))  # BLOCK at most
        rounds.append(arrays)
        up = stored(arrays.mapInArrow(_roots, NODES))
        roots.append(up.where("n = 1").select("tree", "hash", F.lit(len(rounds) - 1).alias("round")))
        nodes = up.where("n > 1")
        if nodes.isEmpty():
            return rounds, reduce(DataFrame.unionAll, roots)
        none = {c: F.lit(None).cast(kind) for c, kind in (("id", "bigint"), ("other", "binary"), ("name", "string"))}
        nodes = nodes.withColumns(none)


def descended(rounds: list[DataFrame], above: DataFrame, last, schema: str) -> DataFrame:
    """What ``last`` makes of the first round's arrays with the path from their tree's root: ``above`` has
    (tree, round, path, subroot, root) of each tree."""
    out = None
    for k in range(len(rounds) - 1, -1, -1):
        own = above.where(F.col("round") == k).select("tree", F.lit(0).cast("bigint").alias("block"), "path", "subroot", "root")
        if out is not None:
            own = own.unionAll(out.select("tree", F.col("index").alias("block"), "path", "subroot", "root"))
        joined = rounds[k].join(own, ["tree", "block"])
        out = joined.mapInArrow(last, schema) if not k else stored(joined.mapInArrow(_paths, PATHS))
    return out


# --- the manifest ------------------------------------------------------------------------------------------------


def proved(df: DataFrame, doc_id: str, group: str, columns: list[str], now: dict[str, Column]) -> DataFrame:
    """A row for each row of ``df``: leaf, subroot and root of the table as it is, the digest of its proof, and the root
    that its leaf gives with the columns ``now`` and the siblings of the table as it is."""
    before = [df[f"`{c}`"] for c in columns]
    after = leaf([now.get(c, own) for c, own in zip(columns, before)])
    rows = df.select(tree_of(df[f"`{group}`"]).alias("tree"), df[f"`{doc_id}`"].cast("bigint").alias("id"), leaf(before).alias("leaf"), after.alias("other"))
    rows = stored(rows.withColumn("other", F.expr("nullif(other, leaf)")))
    leaves = placed(rows).withColumnRenamed("leaf", "hash").withColumn("name", F.lit(None).cast("string"))
    rounds, subroots = climbed(leaves)
    # the tree over the groups; its nodes are numbered in the order of their names
    ordered = stored(common.in_order(subroots, ["tree"]))
    n = ordered.count()
    tops = common.numbered(ordered).select(
        F.lit("").alias("tree"), F.col("_row").alias("index"), F.lit(n).cast("bigint").alias("n"), "hash",
        F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("other"), F.col("tree").alias("name"),
    )
    top_rounds, root = climbed(tops)
    above = root.select(
        "tree", "round", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"),
        F.lower(F.hex("hash")).alias("root"),
    )
    paths = stored(descended(top_rounds, above, _paths, PATHS)).select(F.col("name").alias("tree"), "path", "root")
    above = stored(paths.join(subroots.select("tree", "round", F.lower(F.hex("hash")).alias("subroot")), "tree"))
    proofs = descended(rounds, above, _proofs, PROOFS)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", "doc_id")
