"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every hash of a five-word shingle that lies in the lowest ``1/SCALE`` of the hash range, sorted, each
once.  Which hashes are kept depends on the hash alone, so sketches of any two texts can be compared and merged however
unequal the texts are: the share of A's kept hashes that B has too estimates how much of A is contained in B, and the
sketch of two texts together is the union of theirs (``merged``).

A text of one to four words is one shingle.  A text whose shingles all lie above the threshold (with k shingles, one text
in ``2**k`` at a scale of 2) has its least hash as a stand-in, so that it still has a fingerprint, like those of equal
texts only.  How much of such a text is contained in another that kept hashes is not known from sketches: containment is
null there.  A merge drops stand-ins again if any hash lies below.  Null or empty texts, and texts of
white space, have the empty sketch, which is like another empty one (1) and unlike all others (0).

Words are runs of characters other than ASCII white space, case counts.  As text a sketch is the hashes' 16 hex digits
end to end.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from . import common

SHINGLE = 5
# One of so many hashes is kept.
SCALE = 2


def threshold(scale: int = SCALE) -> int:
    """Signed hashes below this are kept."""
    return -(1 << 63) + (1 << 64) // scale


def with_sketch(df: DataFrame, text: str, out: str, scale: int = SCALE) -> DataFrame:
    """Adds the sketch (sorted array of hashes) of a column of text."""
    words, hashes, low = common.fresh(df, "_words", "_hashes", "_low")
    split = F.regexp_extract_all(common.text_of(df, text), F.lit(common.WORD), F.lit(0))
    df = df.withColumn(words, split)
    after = ", ".join(f"get(`{words}`, i + {k})" for k in range(1, SHINGLE))  # nothing beyond the end
    whole = f"slice(`{words}`, 1, greatest(size(`{words}`) - {SHINGLE - 1}, 1))"
    df = df.withColumn(hashes, F.expr(f"transform({whole}, (w, i) -> xxhash64(w, {after}))")).drop(words)
    kept = F.expr(f"sort_array(array_distinct(filter(`{hashes}`, h -> h < {threshold(scale)}L)))")
    df = df.withColumn(low, kept)
    least = f"if(size(`{low}`) > 0 OR size(`{hashes}`) = 0, `{low}`, array(array_min(`{hashes}`)))"
    return df.withColumn(out, F.expr(least)).drop(hashes, low)


def as_text(sketch: str) -> Column:
    return F.expr(f"array_join(transform(`{sketch}`, h -> lower(lpad(hex(h), 16, '0'))), '')")


def merged(df: DataFrame, by: list[str], sketch: str, out: str = "sketch", scale: int = SCALE) -> DataFrame:
    """The sketch of all texts of each group together; equal hashes go before they are moved."""
    each = df.select(*by, F.explode(sketch).alias("_h")).distinct()
    found = each.groupBy(*by).agg(F.collect_list("_h").alias("_all"))
    low = F.expr(f"sort_array(filter(_all, h -> h < {threshold(scale)}L))")
    return found.select(*by, F.when(F.size(low) > 0, low).otherwise(F.array(F.array_min("_all"))).alias(out))


def stands_in(sketch: str, scale: int = SCALE) -> Column:
    """Whether the sketch is a stand-in: no hash of its text was kept."""
    return (F.size(sketch) == 1) & (F.get(sketch, F.lit(0)) >= threshold(scale))


def containment(a: str, b: str, scale: int = SCALE) -> Column:
    """How much of ``a`` lies in ``b``: 1 if ``a`` is empty and ``b`` too, 0 if only one is; null if only ``a`` is a stand-in."""
    shared = F.size(F.array_intersect(a, b)) / F.size(a)
    known = F.when(stands_in(a, scale) & ~stands_in(b, scale), F.lit(None).cast("double")).otherwise(shared)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), known).otherwise((F.size(a) == F.size(b)).cast("double"))


def likeness(a: str, b: str) -> Column:
    """Shared shingles among those of either, between 0 and 1."""
    shared = F.size(F.array_intersect(a, b))
    all_ = F.size(a) + F.size(b) - shared
    return F.when(all_ > 0, shared / all_).otherwise(F.lit(1.0))


def _keys(keys: list[tuple]) -> str:
    each = (f"named_struct('known', {k}, 'id', CAST({i} AS BIGINT), 'hash', CAST({h} AS BIGINT))" for k, i, h in keys)
    return f"array({', '.join(each)})"


def _range(bounds: list[tuple], key: str) -> Column:
    """How many of the sorted bounds are at most ``key``, in two steps of about the root of their number."""
    step = isqrt(len(bounds)) + 1
    blocks = f"size(filter({_keys(bounds[::step])}, b -> b <= {key}))"
    within = f"slice({_keys(bounds)}, ({blocks} - 1) * {step} + 1, {step})"
    return F.expr(f"if({blocks} = 0, 0, ({blocks} - 1) * {step} + size(filter({within}, b -> b <= {key})))")


def with_next(df: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """doc_id, text (null as empty) and next_text: the text after it in ascending order of id; after the last the first.

    The columns ``more`` come along, each with its next value as ``next_<name>``.

    Ids and hashes of texts alone are sorted to find the bounds of ranges; the texts move once, into their ranges.
    A range also gets the first row of the range after it.  Rows with equal ids are ordered by a hash of their texts.
    """
    body = common.text_of(df, text)
    known = F.col("doc_id").isNotNull()
    rows = df.select(df[f"`{doc_id}`"].alias("doc_id"), body.alias("text"), *more)
    key = F.struct(known.cast("int").alias("known"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), F.xxhash64("text").alias("hash"))
    rows = rows.withColumn("_key", key)
    ordered = stored(common.in_order(rows.select("_key"), ["_key"]))
    first = ordered.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.min("_key").alias("_key"))
    bounds = sorted(tuple(r._key) for r in first.collect())  # a row for each partition
    if not bounds:
        return rows.select("*", *(F.col(c).alias(f"next_{c}") for c in ("text", *more)))
    own = _range(bounds, "_key")
    starts = F.expr(f"element_at({_keys(bounds)}, _range) = _key")
    before = F.when(F.col("_range") > 1, F.col("_range") - 1).otherwise(len(bounds))
    both = F.when(starts, F.array(F.col("_range"), before)).otherwise(F.array("_range"))
    dealt = rows.withColumn("_range", own).select("doc_id", "text", *more, "_key", F.posexplode(both).alias("_extra", "_in"))
    window = Window.partitionBy("_in").orderBy("_extra", "_key")
    nexts = {f"next_{c}": F.lead(c).over(window) for c in ("text", *more)}
    return dealt.withColumns(nexts).where("_extra = 0").drop("_key", "_extra", "_in")


def compared(df: DataFrame, doc_id: str, text: str, scale: int = SCALE) -> DataFrame:
    """Sketches of each text, of its edited text (second half from the next document) and of the next text's likeness."""
    rows = df.select(df[f"`{doc_id}`"].alias("doc_id"), common.text_of(df, text).alias("text"))
    pairs = with_next(with_sketch(rows, "text", "sketch", scale), "doc_id", "text", "sketch")
    pairs = pairs.withColumn("n_chars", F.char_length("text").cast("bigint"))
    pairs = pairs.withColumn("_half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = "concat(substring(text, 1, CAST(n_chars AS INT) - _half), substring(next_text, 1, _half))"
    pairs = pairs.withColumn("edited", F.expr(edited))
    pairs = pairs.withColumn("edited_sha256", F.sha2("edited", 256))
    pairs = with_sketch(pairs, "edited", "edited_sketch", scale)
    return pairs.select(
        "doc_id", "n_chars", "edited_sha256", as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"), likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
        containment("sketch", "edited_sketch", scale).alias("contained_in_edited"),
        containment("sketch", "next_sketch", scale).alias("contained_in_next"),
        stands_in("sketch", scale).alias("stands_in"),
    )
