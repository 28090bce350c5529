"""Filter interaction audit over a sparse document-term matrix.

*Matrix.*  Each task cuts its texts into shards of about ``SHARD_BYTES`` and keeps a shard as compressed sparse rows (CSR)
over the shard's own words: where each document's entries start, the words, how often each occurs.  A global dictionary
then numbers all words without gaps: each shard sends each of its different words once, words meet by hash bucket, are
numbered in order within it, and prefix sums over the buckets' counts give the bases.  Back at the shards the numbers
replace the shards' own.  No word is frequent on this way, as a shard has it once; no task holds more than a shard.

*Filters.*  Words are maximal runs of characters other than ASCII white space.  A document fails

* A with under 50 words (the sum of its row),
* B if different words (its nonzero entries) are under 65 % of its words,
* C if over 5 % of its characters are ``A-Z``,
* D with any of ``#$%&*|``,
* E if a document with a smaller id has the same text (by SHA-256), wherever in the table, removed or not.

*Audit.*  Failures are bits of a mask, and documents with one mask fare alike under any order of the filters, so the
counts per part and mask (32 at most) tell everything: what is kept and removed at each step of each order, what a step
would have removed had an earlier one not done so, what only it removes, and its share over all orders.

A null text counts as empty, a null part as the empty string.  A null id is smaller than none, and none is smaller than
it.  Repeated rows count each; of equal texts with equal ids none fails E for the other.  Labels that occur more than once
for an id count as set if any of them is; those of a null id are nobody's.  An empty table gives an empty audit.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from . import common

# Bytes of text in a shard, about (a longer text is a shard of its own).
SHARD_BYTES = 14 << 20
# Bytes of text whose words are looked for at a time.
STEP_BYTES = 512 << 10
# Words that a bucket of the dictionary holds, about.
BUCKET_WORDS = 2_000_000

FILTERS = "ABCDE"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # of 100 words
MOST_CAPITALS = 5  # of 100 characters
MARKS = "#$%&*|"

# A shard's arrays are little-endian 32-bit integers (``starts``), planes of bytes (``entries`` and ``counts``: the lowest
# byte of all numbers, then the next, as many as the largest needs) or 32 bytes a document (``digests``), end to end.
# Higher planes are long runs, as a row's entries ascend, so they take next to nothing once compressed.
SHARDS = (
    "shard long, ids array<long>, parts array<string>, digests binary, fails binary, "
    "starts binary, entries binary, counts binary, words array<string>"
)
ROWS = "doc_id long, part string, digest binary, fails int, n_words long, n_distinct long"


# --- the matrix --------------------------------------------------------------------------------------------------


def _flags(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Failures of C and D of the rows that start at ``at``."""

    def number(of: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(of), at))

    capitals = number((data >= 0x41) & (data <= 0x5A))
    characters = np.diff(at) - number((data & 0xC0) == 0x80)
    marks = number(np.isin(data, np.frombuffer(MARKS.encode(), np.uint8)))
    return np.where(100 * capitals > MOST_CAPITALS * characters, BIT["C"], 0) | np.where(marks > 0, BIT["D"], 0)


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers from 0 as planes of bytes, the lowest first; planes above the largest number's are left out."""
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return numbers.astype("<i4", copy=False).view("u1").reshape(-1, 4)[:, :width].T.tobytes()


def from_planes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 4), "u1")
    if n:
        out[:, : len(data) // n] = np.frombuffer(data, "u1").reshape(-1, n).T
    return out.view("<i4").reshape(-1)


def _shard(number: int, ids: pa.ChunkedArray, parts: pa.ChunkedArray, texts: list[pa.Array]) -> pa.RecordBatch:
    """One row: the CSR of these texts over their own words."""
    words, owner, fails, digests = [], [], [], []
    rows = 0
    for column in texts:
        for a, b in common.slices(column, STEP_BYTES):
            data, at = common.utf8(column.slice(a, b - a))
            starts, ends, row = common.spans(common.word_bytes()[data], at)
            words.append(common.packed(data, starts, ends).dictionary_encode())
            owner.append((row + rows).astype(np.int32))
            fails.append(_flags(data, at))
            digests += [hashlib.sha256(data[i:j]).digest() for i, j in zip(at, at[1:])]
            rows += b - a
    column = pa.chunked_array(words, pa.dictionary(pa.int32(), pa.large_binary())).unify_dictionaries()
    del words
    own = column.chunk(0).dictionary if column.num_chunks else pa.array([], pa.large_binary())
    size, code, at = max(len(own), 1), np.empty(len(column), np.int64), 0
    for chunk, row in zip(column.chunks, owner, strict=True):
        part = code[at : at + len(chunk)]
        np.multiply(row, size, out=part, dtype=np.int64)
        part += chunk.indices.to_numpy()
        at += len(chunk)
    del column, owner
    code.sort()
    new = np.ones(len(code), bool)
    np.not_equal(code[1:], code[:-1], out=new[1:])
    first = np.flatnonzero(new).astype(np.int32)
    counts = np.diff(first, append=np.int32(len(code)))
    code = code[first]
    del new, first
    starts = np.searchsorted(code, np.arange(rows + 1) * size)
    code %= size

    def listed(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    packed = [b"".join(digests), np.concatenate(fails).astype("u1"), starts.astype("<i4"), planes(code.astype("<i4")), planes(counts)]
    columns = [
        pa.array([number], pa.int64()), listed(ids.combine_chunks()), listed(parts.combine_chunks()),
        *(pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in packed),
        listed(own.cast(pa.large_string()).cast(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in SHARDS.split(", ")])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for a, b in common.slices(batch.column(2), SHARD_BYTES):
            some = batch.slice(a, b - a)
            n = int(np.diff(common.offsets(some.column(2))).sum())
            if held and size + n > SHARD_BYTES:
                cut = _shard(number, *_columns(held))
                number, held, size = number + 1, [], 0
                yield cut
                del cut
                pa.default_memory_pool().release_unused()
            held.append(some)
            size += n
    if held:
        yield _shard(number, *_columns(held))


def _columns(held: list[pa.RecordBatch]) -> tuple[pa.ChunkedArray, pa.ChunkedArray, list[pa.Array]]:
    ids, parts = (pa.chunked_array([b.column(k) for b in held]) for k in (0, 1))
    return ids, parts.cast(pa.string()), [b.column(2) for b in held]


def shards(df: DataFrame, doc_id: str, part: str, text: str) -> DataFrame:
    """The CSR shards of all texts, each over its own words; stored."""
    common.small_batches(df.sparkSession)
    rows = df.select(
        df[f"`{doc_id}`"].cast("bigint").alias("id"), F.coalesce(df[f"`{part}`"].cast("string"), F.lit("")).alias("part"),
        common.text_of(df, text).alias("text"),
    )
    return stored(rows.mapInArrow(_cut, SHARDS))


def dictionary(shards: DataFrame) -> DataFrame:
    """(shard, local, word, id): the global number of each shard's words; ``word`` in one row of each word only.

    Numbers go from 0 without gaps.
    """
    spark = shards.sparkSession
    words = shards.select("shard", F.posexplode("words").alias("local", "word"))
    n = shards.agg(F.sum(F.size("words").cast("bigint"))).first()[0] or 0
    buckets = max(common.partitions(spark), -(-n // BUCKET_WORDS))
    words = words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
    ordered = Window.partitionBy("bucket").orderBy("word", "shard")
    first = F.coalesce(F.col("word") != F.lag("word").over(ordered), F.lit(True))
    words = words.withColumn("_first", first)
    words = words.withColumn("_place", F.sum(F.col("_first").cast("bigint")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    kept = stored(words.select("shard", "local", F.expr("if(_first, word, null)").alias("word"), "bucket", "_place"))
    counts = kept.groupBy("bucket").agg((F.max("_place") + 1).alias("_n"))
    base = "coalesce(sum(_n) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _base"
    bases = F.broadcast(counts.selectExpr("bucket", base))  # a row for each bucket
    return kept.join(bases, "bucket").select("shard", "local", "word", (F.col("_base") + F.col("_place")).alias("id"))


def matrix(shards: DataFrame, words: DataFrame) -> DataFrame:
    """The shards with global numbers: ``words`` is replaced by ``numbers``, (local, id) of each of the shard's own words."""
    numbers = words.groupBy("shard").agg(F.collect_list(F.struct("local", "id")).alias("numbers"))  # as many as its words
    return shards.drop("words").join(numbers, "shard", "left")


def arrays(starts: bytes, entries: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's CSR: where each document's entries start (one more at the end), the entries' words, and their counts."""
    at = np.frombuffer(starts, "<i4").astype(np.int64)
    return at, from_planes(entries, at[-1]), from_planes(counts, at[-1])


def global_numbers(numbers: pa.ListScalar) -> np.ndarray:
    """The numbers of a shard's words, by their places there."""
    if not numbers.is_valid:
        return np.zeros(0, np.int64)
    local, number = (numbers.values.field(k).to_numpy() for k in (0, 1))
    out = np.full(len(local), -1, np.int64)
    out[local] = number
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in ROWS.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            ids, parts, digests, fails, *csr, numbers = (c[i] for c in batch.columns)
            starts, entry, counts = arrays(*(x.as_py() for x in csr))
            column = global_numbers(numbers)[entry]
            total = np.r_[0, np.cumsum(counts, dtype=np.int64)]
            n, distinct = np.diff(total[starts]), np.diff(starts)
            assert len(column) == starts[-1] and (column >= 0).all(), "an entry without a number"
            failed = np.frombuffer(fails.as_py(), "u1") | np.where(n < LEAST_WORDS, BIT["A"], 0) | np.where(100 * distinct < LEAST_DISTINCT * n, BIT["B"], 0)
            digest = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(n), [None, digests.as_buffer()])
            yield pa.RecordBatch.from_arrays(
                [ids.values, parts.values, digest.cast(pa.binary()), pa.array(failed, pa.int32()), pa.array(n, pa.int64()), pa.array(distinct, pa.int64())],
                names,
            )
        pa.default_memory_pool().release_unused()


def failures(matrix: DataFrame) -> DataFrame:
    """A row for each document: its failures of A to D as a mask, and what A and B were decided by."""
    columns = ("ids", "parts", "digests", "fails", "starts", "entries", "counts", "numbers")
    return matrix.select(*columns).mapInArrow(_rows, ROWS)


def with_copies(rows: DataFrame) -> DataFrame:
    """Adds failures of E.  ``rows`` is read twice."""
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n"))
    texts = stored(texts)
    placed = common.lookup(rows, texts.select("digest", "_least"), "digest", hot=texts.select("digest", "_n"))
    copy = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    return placed.withColumn("fails", F.col("fails") + F.when(copy, BIT["E"]).otherwise(0)).drop("_least")


# --- the audit ---------------------------------------------------------------------------------------------------


def _steps() -> str:
    """All orders and their steps: the filter's bit, and those of the filters before it."""
    return json.dumps(
        [
            {"filter_order": "".join(order), "step": k + 1, "own": BIT[order[k]], "before": sum(BIT[x] for x in order[:k])}
            for order in permutations(FILTERS) for k in range(len(order))
        ]
    )


def audited(rows: DataFrame, part: str = "part", fails: str = "fails", good: str = "good", toxic: str = "toxic") -> DataFrame:
    """The audit of documents with a part, a mask of failures, and two labels (booleans, null: no)."""

    def number(label: str):
        return F.sum(F.coalesce(F.col(label), F.lit(False)).cast("bigint"))

    counts = rows.groupBy(F.col(part).alias("part"), F.col(fails).alias("mask"))
    counts = counts.agg(F.count("*").alias("n"), number(good).alias("good"), number(toxic).alias("toxic"))
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    kind = "array<struct<filter_order: string, step: int, own: int, before: int>>"
    steps = cells.select("part", "cells", F.explode(F.from_json(F.lit(_steps()), kind)).alias("_s")).select("part", "cells", "_s.*")

    def total(what: str, where: str) -> str:
        return f"aggregate(cells, 0L, (s, c) -> s + if({where}, {what}, 0L))"

    here, hit = "(c.mask & own) <> 0 AND (c.mask & before) = 0", "(c.mask & own) <> 0"
    orders = len(list(permutations(FILTERS)))
    return steps.selectExpr(
        "part", "filter_order", "step",
        f"{total('c.n', '(c.mask & (own | before)) = 0')} AS kept", f"{total('c.n', here)} AS removed",
        f"{total('c.n', hit + ' AND (c.mask & before) <> 0')} AS redundant", f"{total('c.n', 'c.mask = own')} AS unique_fails",
        f"{total('c.good', here)} AS good_lost", f"{total('c.toxic', here)} AS toxic_lost",
        # a document is removed by each of its failures first in as many orders
        f"{total(f'c.n * CAST({orders} / bit_count(c.mask) AS BIGINT)', hit)} AS shapley",
    )


def audit(df: DataFrame, doc_id: str, part: str, text: str, labels: DataFrame, label_id: str, good: str, toxic: str) -> DataFrame:
    """The whole audit of a table and its labels (1: set)."""
    cut = shards(df, doc_id, part, text)
    rows = stored(failures(matrix(cut, dictionary(cut))))
    rows = with_copies(rows)
    marks = labels.groupBy(labels[f"`{label_id}`"].alias("doc_id")).agg(
        F.max(labels[f"`{good}`"] == 1).alias("good"), F.max(labels[f"`{toxic}`"] == 1).alias("toxic")
    )
    return audited(rows.join(marks, "doc_id", "left"))
