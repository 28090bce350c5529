"""Quality rules: a ledger of failure bits and measurements, and policies applied to it.

Every text is measured once and every rule evaluated once; the ledger keeps the measurements and one bit per failed rule
(``fails``).  A policy is a version and the set of rules that count, that is, a mask: applying it, changing it, or asking
what each rule alone removes needs the ledger only, never the texts.

Words are runs of characters other than ASCII white space.  A null text counts as empty: it has no words and fails the
rule on few words.  Repeated rows are measured each for itself.  An empty table gives an empty ledger, and ablations of
zeros.  Columns named like new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims", "n_stutters"]

# A rule's place is its bit.  Each says when a text fails.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "repeated_lines": "n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines",
    "symbols": "100 * n_symbols > 5 * word_chars",
    "exclaims": "100 * n_exclaims > 60 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "stutters": "100 * n_stutters > 30 * n_words",
}
# What counts, by version.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "repeated_lines", "symbols", "exclaims", "word_length", "stutters"],
}


def mask(names: list[str], rules: dict[str, str] = RULES) -> int:
    places = list(rules)
    return sum(1 << places.index(name) for name in set(names))


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers that are equal just where both parts are."""
    if not len(left):
        return np.zeros(0, np.int64)
    return np.unique(left.astype(np.int64) * (int(right.max()) + 1) + right, return_inverse=True)[1]


def _repeated(word: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Words of each row that lie in a window found twice or more in that row.

    Windows of 2, 4 and 8 words get ranks, each from the ranks of its halves: exact, without hashes.
    """
    rank, size = word, 1
    while size < WINDOW:
        rank = _ranks(rank[: max(len(rank) - size, 0)], rank[size:])  # windows across rows go below
        size *= 2
    n = len(rank)
    inside = np.flatnonzero(row[:n] == row[len(row) - n :]) if n else np.zeros(0, np.int64)
    _, each, count = np.unique(_ranks(rank[inside], row[inside]), return_inverse=True, return_counts=True)
    again = inside[count[each] > 1] if len(inside) else inside
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    return np.bincount(row[np.cumsum(change[:-1]) > 0], minlength=rows)


def measure(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """All measurements of the rows that start at ``at``."""
    rows = len(at) - 1
    of_word = common.word_bytes()[data]
    starts, ends, row = common.spans(of_word, at)

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][at])

    word = common.packed(data, starts, ends).dictionary_encode().indices.to_numpy()
    # a line starts with its row or after a line feed, and ends before one or with its row
    feeds = np.flatnonzero(data == 0x0A)
    first, last = np.sort(np.r_[at[:-1], feeds + 1]), np.sort(np.r_[feeds, at[1:]])
    line_row = np.sort(np.r_[np.arange(rows), np.searchsorted(at, feeds, "right") - 1])
    so_far = np.r_[0, np.cumsum(of_word, dtype=np.int64)]
    full = so_far[last] > so_far[first]
    first, last, line_row = first[full], last[full], line_row[full]
    line = common.packed(data, first, last).dictionary_encode().indices.to_numpy()
    pair = line.astype(np.int64) * rows + line_row
    different = np.unique(pair)
    n_lines = np.bincount(line_row, minlength=rows)
    return {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": per_row(of_word & (data & 0xC0 != 0x80)),
        "n_symbols": per_row(np.isin(data, np.frombuffer(SYMBOLS, np.uint8))),
        "n_dup_lines": n_lines - np.bincount(different % max(rows, 1), minlength=rows),
        "n_repeat_words": _repeated(word, row, rows),
        "n_lines": n_lines,
        "n_exclaims": per_row(data == 0x21),
        "n_stutters": np.bincount(row[1:][(word[1:] == word[:-1]) & (row[1:] == row[:-1])], minlength=rows),
    }


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        found = [measure(*common.utf8(texts.slice(a, b - a))) for a, b in common.slices(texts)]
        columns = [pa.array(np.concatenate([f[m] for f in found]) if found else [], pa.int64()) for m in MEASURES]
        yield pa.StructArray.from_arrays(columns, MEASURES)


def ledger(df: DataFrame, text: str, rules: dict[str, str] = RULES) -> DataFrame:
    """``df`` with the measurements of its texts and ``fails``, a bit for each failed rule."""
    common.small_batches(df.sparkSession)
    (own,) = common.fresh(df, "_measures")
    measured = df.withColumn(own, _measured(common.text_of(df, text)))
    measured = measured.withColumns({m: F.col(f"{own}.{m}") for m in MEASURES}).drop(own)
    bits = [f"if({rule}, {1 << place}L, 0L)" for place, rule in enumerate(rules.values())]
    return measured.withColumn("fails", F.expr(" | ".join(bits)))


def passes(policy: list[str], fails: str = "fails", rules: dict[str, str] = RULES) -> Column:
    """Whether none of the policy's rules failed."""
    return F.col(fails).bitwiseAND(F.lit(mask(policy, rules))) == 0


def filtered(df: DataFrame, text: str, policy: list[str]) -> DataFrame:
    """The rows of ``df``, with its own columns, that pass a policy."""
    whole = df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("_row"), common.text_of(df, text).alias("_text"))
    return ledger(whole, "_text").where(passes(policy)).select("_row.*")


def ablations(entries: DataFrame, policy: list[str], fails: str = "fails", rules: dict[str, str] = RULES) -> DataFrame:
    """For each rule of a policy: how many rows fail it, fail it alone, and are kept without it.

    Rows are counted by their failure bits first, so at most one row for each pattern of bits moves.
    """
    own = mask(policy, rules)
    patterns = entries.groupBy(F.col(fails).bitwiseAND(F.lit(own)).alias("_bits")).agg(F.count("*").alias("_n"))
    counted = []
    for name in policy:
        bit = mask([name], rules)
        for column, keep in (
            ("failed", f"_bits & {bit} != 0"), ("failed_alone", f"_bits = {bit}"), ("kept_without", f"_bits & {own & ~bit} = 0"),
        ):
            counted.append(F.expr(f"coalesce(sum(if({keep}, _n, 0L)), 0L)").alias(f"{name}.{column}"))
    row = patterns.agg(*counted)
    names = ", ".join(f"'{n}', `{n}.failed`, `{n}.failed_alone`, `{n}.kept_without`" for n in policy)
    return row.selectExpr(f"stack({len(policy)}, {names}) AS (rule, failed, failed_alone, kept_without)")
