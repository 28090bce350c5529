"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has a bit for each bit of the 64-bit hashes of a text's four-word shingles, set if over half of them have
it.  Two fingerprints link if they differ in at most ``MOST`` bits; groups are the components of these links.

Links are found without comparing all pairs.  The 64 bits are six blocks; fingerprints with at most four different bits
agree on two blocks at least, so each of the 15 pairs of blocks gets a table in which fingerprints that agree on the pair
share a bucket.  A table is sorted by bucket and by the Gray rank of the remaining bits, where neighbours differ little.
Over each bucket stands a tree of nodes with up to ``FANOUT`` children: a node holds the bits that all fingerprints
below it share and no node above it has yet (a mask and a pattern).  A search starts at the top of its own bucket and adds
up a fingerprint's differences from the patterns on its way down; a node is left, with all below it, when they exceed the
bound, or when everything below is known to belong to the searcher's component already.

Tables are spread by ranges of (table, bucket, Gray rank), so a bucket of any size spans as many tasks as it needs.  Its
parts are compared by pairs of runs of ``RUN`` fingerprints: runs' own masks and patterns prune first, their
fingerprints are joined to what remains.  Searches pass on a link to one fingerprint of each local component for every
other member, so what they return grows with the fingerprints, not with the pairs.

Equal fingerprints are one row from the start.  Null texts and texts without words have fingerprint zero and link like
any other.  Null ids come after all others in choosing the least; a group with none else has a null id.  Repeated rows
each get a result.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from . import common
from .components import components

SHINGLE = 4
SEED = 42
MOST = 4
# Bits of the six blocks, from the lowest; two of them at least are equal where at most four bits differ.
BLOCKS = (11, 11, 11, 11, 10, 10)
TABLES = list(combinations(range(len(BLOCKS)), 2))
FANOUT = 16
RUN = 1024
# Searches that go down together.
TOGETHER = 4096
# Rows of all tables that a task sorts and searches, about.
TASK_ROWS = 1_000_000


# --- fingerprints ------------------------------------------------------------------------------------------------


def hashes(data: np.ndarray, at: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the rows that start at ``at``, and how many each row has."""
    import xxhash

    rows = len(at) - 1
    lower = data + (((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) << np.uint8(5))
    starts, ends, row = common.spans(common.word_bytes()[lower], at)
    words = np.bincount(row, minlength=rows)
    # words with one space after each
    place = np.r_[0, np.cumsum(ends - starts + 1)]
    take = np.arange(place[-1]) + np.repeat(starts - place[:-1], np.diff(place))
    joined = np.r_[lower, np.uint8(0)][take]
    joined[place[1:] - 1] = 0x20
    count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    first = np.cumsum(words) - words
    i = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
    last = np.minimum(i + shingle, np.repeat(first + words, count))
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(place[i].tolist(), (place[last] - 1).tolist())
    return np.fromiter((digest(text[a:b], SEED) for a, b in spans), np.uint64, len(i)), count


def fingerprints(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    found, count = hashes(data, at)
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(count) - count)[some], axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > count[some, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprint(df: DataFrame, text: str) -> Column:
    """The fingerprint of each whole text as a signed 64-bit integer."""
    common.small_batches(df.sparkSession)

    @F.arrow_udf(T.LongType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprints(*common.utf8(texts.slice(a, b - a))) for a, b in common.slices(texts)]
            yield pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))

    return run(common.text_of(df, text))


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- the index over sorted fingerprints --------------------------------------------------------------------------


class Index:
    """Trees of shared bits over buckets of sorted fingerprints."""

    def __init__(self, codes: np.ndarray, bucket: np.ndarray):
        """``bucket``: for each fingerprint the number of its bucket, ascending from 0."""
        self.codes = codes
        low = high = codes
        first, last, of = np.arange(len(codes)), np.arange(1, len(codes) + 1), bucket
        # levels from the leaves up: children of a node follow each other in the level below
        self.levels: list[dict[str, np.ndarray]] = [{"mask": np.full(len(codes), ~np.uint64(0)), "pattern": codes, "first": first, "last": last}]
        while not len(self.levels) > 1 or (of[1:] == of[:-1]).any():
            place = np.arange(len(of)) - np.searchsorted(of, of)  # within the bucket
            starts = np.flatnonzero(place % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
            mask = low | ~high  # bits that all below share
            below = self.levels[-1]
            size = np.diff(np.r_[starts, len(of)])
            below["mask"] = below["mask"] & ~np.repeat(mask, size)
            first, last = first[starts], last[np.r_[starts[1:], len(of)] - 1]
            self.levels.append({"mask": mask, "pattern": low, "first": first, "last": last, "child": starts, "size": size})
            of = of[starts]
        self.top = of  # bucket of each top node

    def search(self, codes: np.ndarray, start: np.ndarray, after: np.ndarray | None, root: np.ndarray | None, own: np.ndarray | None):
        """(searcher, place) for all fingerprints within ``MOST`` bits of the searchers.

        ``start``: the top node of each; ``after``: only places beyond this one; ``root`` and ``own``: components of the
        indexed fingerprints and of the searchers; equal ones are passed over.
        """
        who, node = np.arange(len(codes)), start
        far = np.bitwise_count((codes ^ self.levels[-1]["pattern"][node]) & self.levels[-1]["mask"][node])
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            keep = far <= MOST
            if after is not None:
                keep &= level["last"][node] > after[who] + 1
            if root is not None:
                if depth:
                    low = np.minimum.reduceat(root, level["first"])
                    high = np.maximum.reduceat(root, level["first"])
                    keep &= (low[node] != own[who]) | (high[node] != own[who])
                else:
                    keep &= root[node] != own[who]
            who, node, far = who[keep], node[keep], far[keep]
            if not depth:
                return who, node
            size = level["size"][node]
            below = self.levels[depth - 1]
            child = np.arange(size.sum()) + np.repeat(level["child"][node] - (np.cumsum(size) - size), size)
            who, far = np.repeat(who, size), np.repeat(far, size)
            far = far + np.bitwise_count((codes[who] ^ below["pattern"][child]) & below["mask"][child])
            node = child


def united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Components after links between ``a`` and ``b``; the root of one is its least place."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := root[root], root):
            root = further


def local_links(codes: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Components of sorted fingerprints by all links within their buckets."""
    index = Index(codes, bucket)
    root = np.arange(len(codes))
    near = np.flatnonzero((bucket[1:] == bucket[:-1]) & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= MOST))
    root = united(root, near, near + 1)
    top = np.searchsorted(index.top, bucket)
    alone = np.bincount(bucket, minlength=1)[bucket] == 1
    searchers = np.flatnonzero(~alone)
    for i in range(0, len(searchers), TOGETHER):
        own = searchers[i : i + TOGETHER]
        who, place = index.search(codes[own], top[own], own, root, root[own])
        root = united(root, own[who], place)
    return root


def run_links(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join two runs: pairs of fingerprints, each member of a joint component once."""
    index = Index(right, np.zeros(len(right), np.int64))
    who, place = index.search(left, np.zeros(len(left), np.int64), None, None, None)
    both = np.r_[left, right]
    root = united(np.arange(len(both)), who, place + len(left))
    member = np.flatnonzero(root != np.arange(len(both)))
    return both[member], both[root[member]]


# --- over Spark --------------------------------------------------------------------------------------------------


def _tables(fp: str) -> str:
    """SQL of an array of (table, bucket, Gray rank of the remaining bits)."""
    offset = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]

    def block(k: int) -> str:
        return f"(shiftrightunsigned({fp}, {offset[k]}) & {(1 << BLOCKS[k]) - 1}L)"

    def gathered(blocks: list[int]) -> str:
        out, at = [], 0
        for k in blocks:
            out.append(f"shiftleft({block(k)}, {at})")
            at += BLOCKS[k]
        return " | ".join(out)

    each = []
    for t, pair in enumerate(TABLES):
        rest = [k for k in range(len(BLOCKS)) if k not in pair]
        each.append(f"named_struct('t', {t}, 'bucket', {gathered(list(pair))}, 'gray', {gathered(rest)})")
    return f"array({', '.join(each)})"


FOUND = "a long, b long, t int, bucket long, run long, low long, high long, codes array<long>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range: links within it, and runs of its first and last bucket, which may go on elsewhere."""
    schema = _arrow(FOUND)
    part = TaskContext.get().partitionId()
    tables = [pa.Table.from_batches([b]) for b in batches]
    if not sum(len(t) for t in tables):
        return
    table = pa.concat_tables(tables)
    t, key = table["t"].to_numpy(), table["bucket"].to_numpy()
    codes = table["fp"].to_numpy().view(np.uint64)
    bucket = np.r_[0, np.cumsum((t[1:] != t[:-1]) | (key[1:] != key[:-1]))]
    root = local_links(codes, bucket)
    member = np.flatnonzero(root != np.arange(len(root)))
    signed = codes.view(np.int64)
    for i in range(0, len(member), 10_000):
        some = member[i : i + 10_000]
        yield _batch(schema, a=signed[some], b=signed[root[some]])
    run = part << 32
    for b in sorted({0, int(bucket[-1])}):
        first, last = np.searchsorted(bucket, [b, b + 1])
        for i in range(first, last, RUN):
            some = codes[i : min(i + RUN, last)]
            low, high = np.bitwise_and.reduce(some).view(np.int64), np.bitwise_or.reduce(some).view(np.int64)
            yield _batch(schema, t=t[i : i + 1], bucket=key[i : i + 1], run=[run], low=[low], high=[high], codes=[some.view(np.int64)])
            run += 1


def _search_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow("a long, b long")
    for batch in batches:
        for left, right in zip(batch.column(0), batch.column(1)):
            a, b = run_links(*(x.values.to_numpy().view(np.uint64) for x in (left, right)))
            yield _batch(schema, a=a.view(np.int64), b=b.view(np.int64))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
    )


def links(codes: DataFrame, fp: str = "fp") -> DataFrame:
    """(a, b): links of different fingerprints, enough to join all that links join.  ``codes`` is read three times."""
    spark = codes.sparkSession
    rows = codes.select(F.col(fp).alias("fp"), F.explode(F.expr(_tables(f"`{fp}`"))).alias("_x"))
    rows = rows.select("fp", "_x.*")
    for step in (1, 2, 4, 8, 16, 32):  # the rank of a Gray code: each bit with all above it, added modulo 2
        rows = rows.withColumn("gray", F.expr(f"gray ^ shiftrightunsigned(gray, {step})"))
    keys = ["t", "bucket", "gray"]
    tasks = max(common.partitions(spark), -(-codes.count() * len(TABLES) // TASK_ROWS))
    dealt = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    found = stored(dealt.select("t", "bucket", "fp").mapInArrow(_search, FOUND))
    runs = found.where("t IS NOT NULL")
    left = runs.selectExpr("t", "bucket", "run AS run_a", "low AS low_a", "high AS high_a")
    right = runs.selectExpr("t", "bucket", "run AS run_b", "low AS low_b", "high AS high_b")
    pairs = left.join(right, ["t", "bucket"]).where("shiftright(run_a, 32) < shiftright(run_b, 32)")
    # bits in which all of one run differ from all of the other
    apart = "bit_count((low_a ^ low_b) & (low_a | ~high_a) & (low_b | ~high_b))"
    pairs = pairs.where(f"{apart} <= {MOST}").select("run_a", "run_b")
    a, b = (runs.select(F.col("run").alias(f"run_{x}"), F.col("codes").alias(f"codes_{x}")) for x in "ab")
    joined = pairs.join(a, "run_a").join(b, "run_b").select("codes_a", "codes_b")
    more = joined.mapInArrow(_search_runs, "a long, b long")
    return found.where("t IS NULL").select("a", "b").unionAll(more)


def grouped(prints: DataFrame, doc_id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """(fp, n, root, component_id) for each fingerprint: how many rows have it, its component and the least id there."""
    nodes = stored(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("_least"), F.count("*").alias("n")))
    roots = components(links(nodes)).select(F.col("node").alias("fp"), F.col("root").alias("_root"))
    placed = nodes.join(roots, "fp", "left").withColumn("_root", F.coalesce("_root", "fp"))
    placed = stored(placed)
    least = placed.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return common.lookup(placed, least, "_root").select("fp", "n", F.col("_root").alias("root"), "component_id")


def near_duplicates(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, fp and component_id of each row."""
    prints = stored(df.select(df[f"`{doc_id}`"].alias("doc_id"), fingerprint(df, text).alias("fp")))
    groups = stored(grouped(prints))
    hot = groups.select("fp", F.col("n").alias("_n"))
    return common.lookup(prints, groups.select("fp", "component_id"), "fp", hot=hot).select("doc_id", "fp", "component_id")


def one_of_each(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of ``df`` for each component: that with the least id, of equal ids that with the least digest of its text."""
    row, id_, digest = F.struct(*(df[f"`{c}`"] for c in df.columns)), df[f"`{doc_id}`"], F.unhex(F.sha2(common.text_of(df, text), 256))
    own = [F.coalesce(id_.cast("bigint"), F.lit(0)).alias("_id"), id_.isNull().alias("_none"), digest.alias("_digest")]
    prints = stored(df.select(*own, id_.alias("doc_id"), fingerprint(df, text).alias("fp")))
    groups = stored(grouped(prints))
    hot = groups.select("fp", F.col("n").alias("_n"))
    placed = common.lookup(prints, groups.select("fp", "root"), "fp", hot=hot)
    key = ["_none", "_id", "_digest"]
    best = placed.groupBy("root").agg(F.min(F.struct(*key)).alias("_key")).select("_key.*")
    counts = prints.groupBy(*key).agg(F.count("*").alias("_n"))
    best = stored(best.join(counts, key))
    rows = df.select(*own, row.alias("_row"))
    kept = rows.join(best, key).select(*key, "_n", "_row")
    if best.where("_n > 1").isEmpty():
        return kept.select("_row.*")
    # rows that are equal in id and text
    first = kept.where("_n > 1").groupBy(*key).agg(F.any_value("_row").alias("_row"))
    return kept.where("_n = 1").select("_row.*").unionAll(first.select("_row.*"))
