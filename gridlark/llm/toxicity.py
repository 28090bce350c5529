"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits, lower case (ASCII and Latin-1 letters; all other non-ASCII characters count as
letters).  Features are words, their first four and five bytes (so that inflected forms share a feature), pairs of
neighbours, and pairs with one and two words between, each hashed to one of ``1 << BITS`` coordinates and present or not.
FTRL-proximal keeps a learning rate for each coordinate, and its L1 term leaves most weights at exactly zero, so the
model is a short list of coordinates and weights that goes to all tasks.

Training takes a sample of at most ``rows`` labelled documents: as many of the rarer class as there are, up to half, in
the order of a hash of their ids.  The bias is then corrected by the log-odds of the classes' sampling rates, so scores
are those of the labels' own mix whatever the size.  Only ids and labels are sorted for it; texts of sampled documents alone are read by
the one task that trains.  Scoring reads every whole text.

A null text counts as empty; a text without words scores the model's bias.  Labels that are null, or whose id is, are
ignored; of several labels of one id the highest counts.  Without labels of both classes the model has no weights and
scores 0 (only negative ones, or none) or 1 (only positive ones).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BITS = 20
# Bound of the training sample.
TRAINING_ROWS = 12_000
EPOCHS = 4
# FTRL-proximal's learning rate, its offset, and the L1 and L2 terms.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
# Scores from here on mark a document.
THRESHOLD = 0.7

# An odd factor of a polynomial hash modulo 2 ** 64 and its inverse, and one factor for each kind of feature.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_KINDS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)


def _mixed(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x ^ x >> np.uint64(29)) * np.uint64(_KINDS[kind])
    return ((x ^ x >> np.uint64(32)) * np.uint64(_FACTOR) >> np.uint64(64 - BITS)).astype(np.int32)


def _lower(data: np.ndarray) -> np.ndarray:
    data = data + (((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) << np.uint8(5))
    after = np.zeros(len(data), bool)
    after[1:] = (data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[1:] >= 0x80)
    return data + (after.astype(np.uint8) << np.uint8(5))


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all features of the rows that start at ``at``, and the row of each (repeats included)."""
    data = _lower(data)
    letter = np.arange(256) >= 0x80
    letter[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
    starts, ends, row = common.spans(letter[data], at)
    n = len(data)
    powers = np.cumprod(np.r_[np.uint64(1), np.full(n, _FACTOR, np.uint64)], dtype=np.uint64)
    back = np.cumprod(np.r_[np.uint64(1), np.full(n, _INVERSE, np.uint64)], dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], dtype=np.uint64)]

    def hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (sums[b] - sums[a]) * back[a]

    word = hashed(starts, ends)
    found, rows = [_mixed(word, 0)], [row]
    for kind, size in ((1, 4), (2, 5)):
        long = ends - starts > size
        found.append(_mixed(hashed(starts[long], starts[long] + size), kind))
        rows.append(row[long])
    for kind, gap in ((3, 1), (4, 2), (5, 3)):
        same = row[gap:] == row[:-gap]
        pair = word[:-gap] * np.uint64(_KINDS[kind]) + word[gap:]
        found.append(_mixed(pair[same], kind))
        rows.append(row[gap:][same])
    return np.concatenate(found), np.concatenate(rows)


@dataclass
class Model:
    """Bias, and the coordinates that have a weight."""

    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.index] = self.weight
        return table


def fit(examples: list[tuple[int, np.ndarray]], epochs: int = EPOCHS) -> Model:
    """``examples``: label and different coordinates, in the order of training."""
    size = 1 << BITS  # one more for the bias
    z, squares = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for label, index in examples:
            i = np.r_[index, size]
            root = np.sqrt(squares[i])
            w = _weight(z[i], root)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            squares[i] += gradient * gradient
            z[i] += gradient - (np.sqrt(squares[i]) - root) / ALPHA * w
    w = _weight(z, np.sqrt(squares))
    index = np.flatnonzero(w[:size])
    return Model(float(w[size]), index.astype(np.int32), w[index].astype(np.float32))


def _weight(z: np.ndarray, root: np.ndarray) -> np.ndarray:
    return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + root) / ALPHA + L2)


def score(model: Model, table: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    index, row = features(data, at)
    hit = table[index] != 0
    each = np.unique(row[hit].astype(np.int64) << BITS | index[hit])  # each feature of a row once
    total = np.bincount(each >> BITS, table[each & (1 << BITS) - 1], len(at) - 1)
    return 1 / (1 + np.exp(-np.clip(total + model.bias, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Every third id by its checksum; labels of these are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _labelled(labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """One label for each id, and how many ids have each."""
    known = labels.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    return known, {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows


def _take(counts: dict[int, int], rows: int) -> dict[int, int]:
    rare = min((0, 1), key=lambda y: counts.get(y, 0))
    some = min(counts.get(rare, 0), rows // 2)
    return {rare: some, 1 - rare: rows - some}


def _sampled(labels: DataFrame, rows: int) -> DataFrame:
    known, counts = _labelled(labels)
    order = (F.xxhash64("id"), "id")
    parts = [known.where(F.col("label") == y).orderBy(*order).limit(n) for y, n in _take(counts, rows).items()]
    return parts[0].union(parts[1])


def shift(counts: dict[int, int], rows: int) -> float:
    """What the bias of a model from the sample lacks: the log-odds of the classes' sampling rates."""
    if not (counts.get(0) and counts.get(1)):
        return 0.0
    rate = {y: min(n / counts[y], 1.0) for y, n in _take(counts, rows).items()}
    return float(np.log(rate[0] / rate[1]))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        for a, b in common.slices(texts):
            index, row = features(*common.utf8(texts.slice(a, b - a)))
            each = np.unique(row.astype(np.int64) << BITS | index)
            cuts = np.searchsorted(each, np.arange(b - a + 1) << BITS)
            index = (each & (1 << BITS) - 1).astype("<i4")
            found = [index[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(found, pa.binary())],
                ["id", "label", "features"],
            )


def _fit(epochs: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [
            (label, np.frombuffer(index, "<i4"))
            for batch in batches
            for label, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        ]
        labels = {label for label, _ in examples}
        model = fit(examples, epochs) if len(labels) == 2 else Model(30.0 if labels == {1} else -30.0, *np.zeros((2, 0), np.float32))
        yield pa.RecordBatch.from_pydict(
            {"bias": [model.bias], "index": [model.index.astype("<i4").tobytes()], "weight": [model.weight.astype("<f4").tobytes()]}
        )

    return run


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label_id: str, label: str,
    rows: int = TRAINING_ROWS, epochs: int = EPOCHS,
) -> Model:
    """Learns 0/1 labels from at most ``rows`` labelled documents that aren't held out."""
    common.small_batches(docs.sparkSession)
    known = labels.select(labels[f"`{label_id}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("label"))
    known = known.where(~held_out(F.col("id")))
    sample = F.broadcast(_sampled(known, rows))  # at most ``rows`` pairs of numbers
    texts = docs.select(docs[f"`{doc_id}`"].alias("id"), common.text_of(docs, text).alias("text"))
    # a repeated id counts once
    chosen = texts.join(sample, "id").groupBy("id", "label").agg(F.max("text").alias("text"))
    found = chosen.select("id", "label", "text").mapInArrow(_examples, "id long, label int, features binary")
    # another order than the sample's, in which a class that is thinned out would come first
    in_order = found.repartition(1).sortWithinPartitions(F.xxhash64("id", F.lit(1)), "id").select("label", "features")
    row = in_order.mapInArrow(_fit(epochs), "bias double, index binary, weight binary").first()
    if row is None:  # nothing to learn from
        return Model(-30.0, np.zeros(0, np.int32), np.zeros(0, np.float32))
    return Model(row.bias + shift(_labelled(known)[1], rows), np.frombuffer(row["index"], "<i4"), np.frombuffer(row["weight"], "<f4"))


def scored(df: DataFrame, text: str, model: Model) -> Column:
    """The score of each whole text as a column, 0 to 1."""
    common.small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast((model.bias, model.index, model.weight))  # at most 1 << BITS pairs

    @F.arrow_udf(T.DoubleType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*sent.value)
        table = own.dense()
        for texts in batches:
            found = [score(own, table, *common.utf8(texts.slice(a, b - a))) for a, b in common.slices(texts)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    return run(common.text_of(df, text))


def filtered(df: DataFrame, text: str, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, with its own columns, that score below the threshold."""
    (own,) = common.fresh(df, "_score")
    return df.withColumn(own, scored(df, text, model)).where(F.col(own) < threshold).drop(own)
