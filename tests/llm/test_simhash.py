import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from gridlark.llm import components, simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(len(words) - 3, 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(codes):
    """Components by comparing all pairs."""
    codes = np.array(codes, np.uint64)
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def clouds(seed, centers, each, flips):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(centers):
        code = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(each):
            out.add(code)
            if rng.random() < 0.5:
                code = code
            walk = code
            for b in rng.choice(64, int(rng.integers(1, flips + 1)), replace=False):
                walk ^= 1 << int(b)
            out.add(walk)
            if rng.random() < 0.3:
                code = walk
    return sorted(out)


def partition(codes, roots):
    groups = {}
    for c, r in zip(codes, roots):
        groups.setdefault(r, set()).add(c)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("shape", [(60, 1, 4), (20, 30, 5), (3, 400, 6), (400, 2, 9)])
def test_links_join_what_all_pairs_join(spark, shape):
    codes = clouds(sum(shape), *shape)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(signed)], "doc_id long, fp long").repartition(3)
    got = {r.fp: r.component_id for r in simhash.grouped(df).collect()}
    assert partition(codes, [got[c] for c in signed]) == partition(codes, classes(codes))


def test_buckets_cut_by_ranges(spark, monkeypatch):
    """One bucket over many partitions: its runs are compared across them."""
    rng = np.random.default_rng(4)
    codes = sorted({int(x) for x in rng.integers(0, 1 << 21, 3000)})  # agree on the high blocks
    monkeypatch.setattr(simhash, "RUN", 32)
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "doc_id long, fp long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {r.fp: r.component_id for r in simhash.grouped(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert partition(codes, [got[c] for c in codes]) == partition(codes, classes(codes))


def test_documents(docs, rows):
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs, "doc_id", "text").collect())
    codes = [fingerprint(r[1] or "") for r in rows]
    roots = classes(codes)
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min((x for x in (r[0], least.get(root)) if x is not None), default=None)
    assert got == Counter((r[0], c, least[root]) for r, c, root in zip(rows, codes, roots))


def test_one_of_each(docs, rows):
    kept = simhash.one_of_each(docs, "doc_id", "text")
    assert kept.schema == docs.schema
    codes = [fingerprint(r[1] or "") for r in rows]
    roots = classes(codes)
    best = {}
    for r, root in zip(rows, roots):
        best[root] = min(best.get(root, 1 << 62), r[0] if r[0] is not None else 1 << 62)
    got = kept.collect()
    assert sorted(r.doc_id if r.doc_id is not None else 1 << 62 for r in got) == sorted(best.values())


def test_components_of_paths_and_stars(spark):
    n = 200
    path = [(i, i + 1) for i in range(n)]
    star = [(1000, 1000 + i) for i in range(1, 3000)]
    mixed = [(int(a), int(b)) for a, b in np.random.default_rng(2).permutation(path)]
    df = spark.createDataFrame([*mixed, *star, (5000, 5000), (7, 6), (7, 6)], "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(3000)}}
    assert components.components(df.where("a = 5000")).count() == 0


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs, "doc_id", "text").count() == 0
    assert simhash.one_of_each(no_docs, "doc_id", "text").count() == 0
