import hashlib

import pytest
from samples import sentence

from gridlark.llm import fingerprints


def sketch(text: str, hash_of: dict) -> set:
    words = split(text)
    shingles = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    hashes = {hash_of[s] for s in shingles}
    low = {h for h in hashes if h < fingerprints.threshold()}
    return low or ({min(hashes)} if hashes else set())


def split(text: str) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.fixture(scope="module")
def found(docs):
    return fingerprints.compared(docs, "doc_id", "text").collect()


def test_against_brute_force(spark, rows, found):
    order = spark.createDataFrame([(r[0], r[1] or "") for r in rows], "id long, t string")
    order = [(r.id, r.t) for r in order.selectExpr("id", "t", "xxhash64(t) AS h").orderBy("id", "h").collect()]
    want = []
    for k, (id_, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        want.append((id_, text, text[: len(text) - half] + after[:half], after))
    everything = {s for w in want for t in w[1:] for s in shingles_of(t)}
    listed = sorted(everything)
    shown = spark.createDataFrame([(i, list(s)) for i, s in enumerate(listed)], "i long, w array<string>")
    hashes = {listed[r.i]: r.h for r in shown.selectExpr("i", "xxhash64(w[0], get(w, 1), get(w, 2), get(w, 3), get(w, 4)) AS h").collect()}

    def as_text(s):
        return "".join(f"{h % (1 << 64):016x}" for h in sorted(s))

    def like(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    expected = []
    for id_, text, edited, after in want:
        a, b, c = (sketch(t, hashes) for t in (text, edited, after))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        expected.append((named(id_), len(text), digest, as_text(a), as_text(b), like(a, b), like(a, c)))
    columns = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((named(r.doc_id), *(r[c] for c in columns)) for r in found) == sorted(expected)


def named(id_):
    return -1 if id_ is None else id_


def shingles_of(text):
    words = split(text)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_equal_texts_have_equal_fingerprints(found, rows):
    prints = {}
    texts = {r[0]: r[1] or "" for r in rows if r[0] not in (None, 5)}
    for r in found:
        if r.doc_id in texts:
            assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_estimates_of_long_texts(spark):
    texts = [sentence(1000, 4000), sentence(1000, 4000), " ".join([sentence(1000, 4000), sentence(2000, 12000)])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = fingerprints.compared(df, "doc_id", "text").orderBy("doc_id").collect()
    assert rows[0].near_next == 1.0
    assert abs(rows[1].contained_in_next - 1) < 0.01 and abs(rows[1].near_next - 0.25) < 0.05


def test_merged_sketches_are_those_of_all_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (1, "k l m n o p q r s t"), (2, "a b"), (2, "x"), (3, "")], "g int, text string")
    sketches = fingerprints.with_sketch(df, "text", "sketch", 2)
    merged = {r.g: r.sketch for r in fingerprints.merged(sketches, ["g"], "sketch", scale=2).collect()}
    own = {}
    for r in sketches.collect():
        own.setdefault(r.g, set()).update(r.sketch)
    low = {h for h in own[1] if h < 0}
    assert merged[1] == sorted(low or {min(own[1])})
    assert 3 not in merged  # nothing to keep


def test_empty_table_and_single_row(spark, no_docs):
    assert fingerprints.compared(no_docs, "doc_id", "text").count() == 0
    one = spark.createDataFrame([(4, "ab cd")], "doc_id long, text string")
    (row,) = fingerprints.compared(one, "doc_id", "text").collect()
    assert row.near_next == 1.0 and row.n_chars == 5 and row.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()


def test_short_texts_inside_long_ones(spark):
    """A short text that kept a hash is wholly contained; of one that kept none nothing is said."""
    long = sentence(3000, 5000).split()
    texts = [" ".join(long[i : i + 10]) for i in range(0, 2000, 20)] + [" ".join(long[i : i + 5]) for i in range(0, 400, 20)]
    df = spark.createDataFrame([(i, t, " ".join(long)) for i, t in enumerate(texts)], "doc_id long, text string, whole string")
    df = fingerprints.with_sketch(fingerprints.with_sketch(df, "text", "a"), "whole", "b")
    got = df.select("doc_id", fingerprints.containment("a", "b").alias("c"), fingerprints.containment("b", "a").alias("back"), fingerprints.stands_in("a").alias("s")).collect()
    assert {r.c for r in got if not r.s} == {1.0} and {r.c for r in got if r.s} <= {None}
    assert all(0 <= r.back < 0.01 for r in got)
    assert sum(r.s for r in got if r.doc_id < 100) <= 8  # six shingles: one text in 64
    assert 2 <= sum(r.s for r in got if r.doc_id >= 100) <= 18  # one shingle: one in two
