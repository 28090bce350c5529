import zlib
from collections import Counter

import pytest

from gridlark.llm import feistel


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 100, 900, 1000, 4097])
@pytest.mark.parametrize("seed", [0, 5])
def test_permutation_and_its_inverse(spark, n, seed):
    df = spark.range(n).selectExpr("id", f"{feistel.permuted('id', n, seed)} AS p")
    rows = df.selectExpr("id", "p", f"{feistel.permuted('p', n, seed, back=True)} AS b").collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.b == r.id for r in rows)


def test_it_shuffles(spark):
    n = 10_000
    rows = spark.range(n).selectExpr("id", f"{feistel.permuted('id', n, 0)} AS p").collect()
    p = [r.p for r in sorted(rows)]
    assert sum(abs(a - b) < 100 for a, b in zip(p, p[1:])) < 400  # 2 % by chance
    assert sum(x == i for i, x in enumerate(p)) < 10
    other = [r.p for r in sorted(spark.range(n).selectExpr("id", f"{feistel.permuted('id', n, 1)} AS p").collect())]
    assert sum(a == b for a, b in zip(p, other)) < 10


def test_shards(docs, rows):
    got = feistel.shards(docs, "doc_id", "text", 7).collect()
    body = lambda r: (r[1] or "").encode()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], len(body(r)) + 8, zlib.crc32(body(r))) for r in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    ordered = sorted(got, key=lambda r: r.row)
    assert [r.doc_id for r in ordered if r.doc_id is not None] == sorted(r[0] for r in rows if r[0] is not None)


def test_partitioning_doesn_t_matter(docs):
    small = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    assert sorted(feistel.shards(small, "doc_id", "text", 5).collect()) == sorted(feistel.shards(small.repartition(6), "doc_id", "text", 5).collect())


def test_empty_table(no_docs):
    assert feistel.shards(no_docs, "doc_id", "text", 5).count() == 0
