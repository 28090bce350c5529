"""What several operators share: global row order, joins with hot keys, Arrow batches, words."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that Spark hands to Python at once, so that a batch of long texts stays small.
BATCH_ROWS = 1000
# Bytes of text that Python works on at once (a longer text is worked on alone).
SLICE_BYTES = 1 << 20
# A key with over 1/HOT_SHARE of all rows is hot; so there are at most HOT_SHARE - 1.
HOT_SHARE = 1000
NUMBERS = ("int", "bigint", "double")
# ASCII white space of the word pattern [^\x20\x09-\x0D]+
WORD = r"[^\x20\x09-\x0D]+"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(BATCH_ROWS, int(spark.conf.get(key)))))


def text_of(df: DataFrame, text: str) -> Column:
    """The column as text, null as empty."""
    return F.coalesce(df[f"`{text}`"].cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` hasn't (names differ in more than case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def in_order(df: DataFrame, keys: list[str], at: str = "_at") -> DataFrame:
    """``df`` sorted over all partitions, with ``at``: partition number << 33 + place in the partition.

    Store the result before using it twice: range bounds come from a sample.
    """
    n = partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return dealt.withColumn(at, F.monotonically_increasing_id())


def numbered(ordered: DataFrame, at: str = "_at", number: str = "_row") -> DataFrame:
    """Adds the global row number (from 0) to a stored result of ``in_order``.

    The bases are prefix sums over one count per partition.
    """
    part = F.shiftright(at, 33).alias("_part")
    counts = ordered.groupBy(part).agg(F.count("*").alias("_n"))
    before = "coalesce(sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _base"
    bases = F.broadcast(counts.selectExpr("_part AS _of", before))  # a row for each partition
    row = (F.col("_base") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).alias(number)
    return ordered.join(bases, F.shiftright(at, 33) == F.col("_of")).select(*ordered.columns, row)


def lookup(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right``, which has each ``key`` once; ``key`` may be very frequent in ``left``.

    Keys with more than 1/1000 of the left rows (so at most 999) are spread: their
    left rows get a salt that is the same when a task runs again, their right row
    is repeated for each salt.  ``hot``, if given, tells (key, _n) how often keys
    occur on the left; else ``left`` is read twice.
    """
    n = partitions(left.sparkSession)
    counts = (left.groupBy(key).agg(F.count("*").alias("_n")) if hot is None else hot).withColumnRenamed(key, "_hot")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    floor = max(total // HOT_SHARE, 1000)
    hot = F.broadcast(counts.where((F.col("_n") > floor) & F.col("_hot").isNotNull()).select("_hot"))  # < HOT_SHARE rows
    # copies of one row spread over the tasks that read them
    place = F.xxhash64(*(c for c, t in left.dtypes if t in NUMBERS), F.spark_partition_id())
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(place, F.lit(n))).otherwise(0)
    salted = left.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    spread = right.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(spread, [key, "_salt"], how).drop("_salt")


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold at most ``most`` bytes, or a single row."""
    sizes = np.diff(offsets(column))
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def list_offsets(column: pa.Array) -> np.ndarray:
    """Where each list starts among all values of a list column (one more entry at the end).  No nulls."""
    if not len(column):
        return np.zeros(1, np.int64)
    at = column.offsets.to_numpy().astype(np.int64)
    return at - at[0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and where each row starts (one more entry at the end).  No nulls."""
    at = offsets(column)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def spans(word_byte: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true bytes that don't cross rows: starts, ends, and the row of each."""
    n = len(word_byte)
    edge = np.zeros(n + 1, bool)
    edge[at] = True  # a run stops where a row does
    starts = np.flatnonzero(word_byte & (edge[:-1] | ~np.r_[False, word_byte[:-1]])) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(word_byte & (edge[1:] | ~np.r_[word_byte[1:], False])) + 1 if n else starts
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def word_bytes() -> np.ndarray:
    """For each byte, whether it belongs to a word of ``WORD``."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of ``data`` as one binary array."""
    sizes = ends - starts
    at = np.r_[0, np.cumsum(sizes)]
    take = np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[take])]
    )


def one_thread() -> None:
    """Keeps libraries in a Python worker from starting threads of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
