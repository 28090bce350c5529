"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder, stored
from . import audit, feistel, fingerprints, manifest, mixing, pieces, prefixes, replytrees, rules, simhash, tokens, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# What the contracts fix.
END_ID = 2
SHARDS = 24


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    tokens.write_tokens(_table(spark, sf, "documents"), "doc_id", "text", folder, tokenizer, END_ID)
    return tokens.read_tokens(spark, folder)


@query
def op2_threshold_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compared(_table(spark, sf, "documents"), "doc_id", "text")


@query
def op9_feistel_shards(spark: SparkSession, sf: str) -> DataFrame:
    placed = feistel.shards(_table(spark, sf, "documents"), "doc_id", "text", SHARDS)
    return placed.selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot", "CAST(NULL AS INT) AS grown_shard"
    )


@query
def op3_reply_trees(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one that imitates templates, read back from the written output."""
    says = r"\### Assistant: </turn> ok"
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"),
    )
    messages = replytrees.linear(rows.union(own), "conv_id", "turn", "role", "text")
    written = stored(replytrees.formatted(stored(messages)))
    back = written.select(
        F.col("tree").alias("conv_id"), "formatted", replytrees.parsed().alias("_turns"), replytrees.under_loss().alias("_loss")
    )
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("_turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("_loss").cast("bigint").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op4_ftrl_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    model = toxicity.train(docs, labels, "doc_id", "text", "doc_id", "toxic")
    out = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.scored(docs, "text", model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op5_rule_ledger(spark: SparkSession, sf: str) -> DataFrame:
    entries = rules.ledger(_table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.POLICIES["base"])).alias("base_failed"), rules.passes(rules.POLICIES["v1"]).alias("kept"),
    )


@query
def op6_pivotal_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "source", "text")
    rows = stored(mixing.measured(docs, "doc_id", "source", "text").drop("text"))
    mix = mixing.applied(rows, mixing.decided(rows))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query
def op7_content_archive(spark: SparkSession, sf: str) -> DataFrame:
    archive = warc.write(_table(spark, sf, "pages"), "page_id", "url", "html")
    records = warc.read(spark, archive)
    kind = warc.field("WARC-Type")
    return records.select(
        warc.page_of(warc.field("WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        kind.alias("record_type"), warc.page_of(warc.field("WARC-Refers-To")).alias("refers_to"),
    )


@query
def op8_piece_agenda(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(_table(spark, sf, "documents"), "doc_id", "text", model)


@query
def op10_gray_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"), "doc_id", "text")
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query
def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return prefixes.digests(_table(spark, sf, "documents"), "doc_id", "text", tokenizer)


@query
def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return audit.audit(docs, "doc_id", "source", "text", labels, "doc_id", "quality", "toxic")


@query
def op13_merkle_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Tampering deletes the line feeds of every document whose id has an even checksum."""
    docs = _table(spark, sf, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest.proved(docs, "doc_id", "source", ["doc_id", "source", "lang", "n_chars", "text"], {"text": text})
