import hashlib

from gridlark.llm import warc
from gridlark.llm.queries import QUERIES

BIG, OTHER = "<p>é" * 40, "x" * 100


def test_archive_round_trip(spark):
    rows = [(7, "u7", BIG), (3, "u3", BIG), (9, "a\r\nWARC-Type: x", BIG), (1, None, "small"), (2, "u2", "small"), (4, "u4", None),
            (5, "u5", ""), (None, "n", BIG), (None, "n", OTHER), (8, "u", OTHER * 2), (8, "u", OTHER * 2), (10, "v", "x" * 99)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    archive = warc.write(df, "page_id", "url", "html")
    assert archive.payloads(spark).count() == len({r[2] or "" for r in rows})
    first = {}
    for page, _, html in rows:
        first[html or ""] = min((x for x in (page, first.get(html or "")) if x is not None), default=None)
    got = warc.read(spark, archive)
    out = got.select(
        warc.page_of(warc.field("WARC-Record-ID")).alias("page"), warc.field("WARC-Target-URI").alias("url"), "payload", "record",
        warc.field("WARC-Type").alias("kind"), warc.page_of(warc.field("WARC-Refers-To")).alias("refers"), "digest",
    ).collect()
    want = []
    for page, url, html in rows:
        body = (html or "").encode()
        later = len(body) >= 100 and page != first[html or ""]
        want.append((str(page), (url or "").replace("\r", "%0D").replace("\n", "%0A"), body, "revisit" if later else "response",
                     str(first[html or ""]) if later else "None", hashlib.sha256(body).hexdigest()))
    assert sorted((str(r.page), r.url, bytes(r.payload), r.kind, str(r.refers), r.digest) for r in out) == sorted(want)
    for r in out:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert block == (b"" if r.kind == "revisit" else bytes(r.payload)) + b"\r\n\r\n" and len(block) == size + 4


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(spark, warc.write(df, "page_id", "url", "html")).count() == 0


def test_damaged_payload_raises(spark):
    import pytest

    df = spark.createDataFrame([(1, "u", BIG)], "page_id long, url string, html string")
    archive = warc.write(df, "page_id", "url", "html")
    broken = warc.Archive(archive.folder + "-broken")
    archive.records(spark).write.parquet(f"{broken.folder}/records")
    archive.payloads(spark).selectExpr("digest", "encode('other', 'utf-8') AS payload").write.parquet(f"{broken.folder}/payloads")
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, broken).collect()


def test_query(spark, sf):
    assert QUERIES["op7_content_archive"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
