"""Content-addressed web archive.

``payloads`` holds each different payload once, under its SHA-256 digest; ``records`` holds one row per record with its
exact WARC/1.1 header as text.  Records are put together again by a join on the digest.

The first record of a payload (least page id) is a response.  Later ones with at least ``SMALL`` bytes are revisits that
refer to it; smaller payloads are responses each time.  Payloads of one digest are compared when written (length and a
second, independent hash), and each digest is computed again from the stored bytes when read: a mismatch raises an error.

A null html counts as empty.  Rows that share the least page id of a payload are all responses.  A null page id comes
after all others (``urn:page:null``); if a payload has no other, its rows are responses.  A null url becomes an empty
target; line breaks in a url are percent-encoded.  An empty table gives an empty archive.  Columns that aren't named are
not read.  A payload that holds a large part of all records is stored once and repeated only to join them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder, stored
from . import common

SMALL = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


@dataclass
class Archive:
    folder: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest string, payload binary").parquet(f"{self.folder}/payloads")

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest string, header string").parquet(f"{self.folder}/records")


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write(df: DataFrame, page_id: str, url: str, html: str, folder: str | None = None) -> Archive:
    """Writes a record for each row of ``df``."""
    spark = df.sparkSession
    archive = Archive(folder or scratch_folder(spark))
    payload = F.encode(common.text_of(df, html), "utf-8")
    target = F.replace(F.replace(common.text_of(df, url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = df.select(df[f"`{page_id}`"].alias("page"), target.alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    # numbers only; a partial aggregate brings copies together
    small = rows.withColumn("second", F.xxhash64("payload"))
    heads = stored(small.select("page", "url", "digest", "bytes", "second"))
    firsts = heads.groupBy("digest").agg(
        F.min("page").alias("first"), F.count("*").alias("_n"),
        F.min("bytes").alias("_b"), F.max("bytes").alias("_b2"), F.min("second").alias("_s"), F.max("second").alias("_s2"),
    )
    differ = F.expr("_b <> _b2 OR _s <> _s2")
    firsts = stored(firsts.withColumn("first", F.when(differ, F.raise_error(F.lit("different payloads of one digest"))).otherwise(F.col("first"))))
    # equal digests have equal payloads, checked above: each task passes one of each on
    rows.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.parquet(f"{archive.folder}/payloads")

    known = common.lookup(heads, firsts.select("digest", "first"), "digest", hot=firsts.select("digest", "_n"))
    later = (F.col("bytes") >= SMALL) & ~F.col("page").eqNullSafe(F.col("first"))
    kind = F.when(later, "revisit").otherwise("response")
    refers = F.when(later, F.concat(_line("WARC-Refers-To", _urn(F.col("first"))), F.lit(f"WARC-Profile: {PROFILE}\r\n")))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", _urn(F.col("page"))),
        _line("WARC-Target-URI", F.col("url")), F.lit(f"WARC-Date: {DATE}\r\n"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), F.coalesce(refers, F.lit("")),
        _line("Content-Length", F.when(later, F.lit("0")).otherwise(F.col("bytes").cast("string"))), F.lit("\r\n"),
    )
    known.select("digest", header.alias("header")).write.parquet(f"{archive.folder}/records")
    return archive


def field(name: str, header: str = "header") -> Column:
    """A header field's value, null if there is none."""
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(F.col(header), F.lit(f"\r\n{name}: ")), found)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record: header, payload (the full one, for revisits too), digest, and the record's own bytes."""
    right = F.sha2("payload", 256) == F.col("digest")
    checked = F.when(right, F.col("payload")).otherwise(F.raise_error(F.lit("a payload doesn't have its digest")))
    payloads = archive.payloads(spark).select("digest", checked.cast("binary").alias("payload"))
    whole = common.lookup(archive.records(spark), payloads, "digest", how="left")
    block = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit(b"\r\n\r\n")
    return whole.select("header", "payload", "digest", F.concat(F.encode("header", "utf-8"), block, end).alias("record"))
