import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from gridlark.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """For each (id, part, text): failed filters, by their definitions."""
    ids = defaultdict(list)
    for i, _, t in rows:
        if i is not None:
            ids[t or ""].append(i)
    out = []
    for i, _, t in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w))
        bad += "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        out.append(bad + "E" * (i is not None and any(j < i for j in ids[t])))
    return out


def simulated(rows, labels):
    """Each order applied to each document, step by step."""
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out, shares = Counter(), Counter()
    parts = {p or "" for _, p, _ in rows}
    for order in permutations("ABCDE"):
        name = "".join(order)
        for (i, p, _), bad in zip(rows, failures(rows)):
            p, gone = p or "", False
            for step, x in enumerate(order, 1):
                key = (p, name, step)
                if x in bad:
                    out[*key, "redundant" if gone else "removed"] += 1
                    out[*key, "unique_fails"] += bad == x
                    if not gone:
                        out[*key, "good_lost"] += i in good
                        out[*key, "toxic_lost"] += i in toxic
                        shares[p, x] += 1
                    gone = True
                out[*key, "kept"] += not gone
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {
        (p, "".join(o), k): (*(out[p, "".join(o), k, n] for n in names), shares[p, o[k - 1]])
        for p in parts for o in permutations("ABCDE") for k in range(1, 6)
    }


LABELS = [(0, 1, 0), (1, 0, 1), (1, 1, None), (5, 1, 1), (17, 0, 1), (20, 1, 0), (None, 1, 1), (999, 1, 1), (30, None, None)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_against_simulation(docs, rows, labels):
    got = audit.audit(docs, "doc_id", "source", "text", labels, "doc_id", "quality", "toxic").collect()
    want = simulated([(r[0], r[3], r[1]) for r in rows], LABELS)
    got = {tuple(r[:3]): tuple(r[3:]) for r in got}
    assert got.keys() == want.keys()
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
    assert any(any(v) for v in want.values())


def test_filters_at_their_bounds(spark):
    w = [f"w{i}" for i in range(60)]
    texts = [
        " ".join(w[:49]), " ".join(w[:50]), " ".join(w[:39] + ["w0"] * 21), " ".join(w[:38] + ["w0"] * 22), "A" + "b" * 19, "Ab" * 3,
        "é" * 19 + "A", "#", "a*b", None, "", "\x1f \x85",
    ]
    rows = [(i, "p", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    cut = audit.shards(df, "doc_id", "source", "text")
    got = audit.with_copies(audit.failures(audit.matrix(cut, audit.dictionary(cut))).cache()).collect()
    assert {r.doc_id: r.fails for r in got} == {i: sum(audit.BIT[x] for x in bad) for i, bad in enumerate(failures(rows))}


def test_matrix_gives_the_texts_words(docs, rows, spark, monkeypatch):
    """Numbers mean one word each in all shards, and go from 0 without gaps; shards are small here."""
    whole = audit.shards(docs, "doc_id", "source", "text").count()
    monkeypatch.setattr(audit, "SHARD_BYTES", 2000)
    cut = audit.shards(docs, "doc_id", "source", "text")
    assert cut.count() > whole + 5
    words = audit.dictionary(cut)
    named = {r.id: r.word for r in words.where("word IS NOT NULL").collect()}
    vocabulary = {w for r in rows for w in WORD.findall(r[1] or "")}
    assert sorted(named) == list(range(len(vocabulary))) and set(named.values()) == vocabulary
    got = []
    for r in audit.matrix(cut, words).collect():
        number = {x.local: x.id for x in r.numbers or []}
        starts, entries, counts = (x.tolist() for x in audit.arrays(r.starts, r.entries, r.counts))
        for i, a, b in zip(r.ids, starts, starts[1:]):
            got.append((i, tuple(sorted((named[number[e]], n) for e, n in zip(entries[a:b], counts[a:b])))))
    want = [(r[0], tuple(sorted(Counter(WORD.findall(r[1] or "")).items()))) for r in rows]
    assert Counter(got) == Counter(want)


def test_null_parts_join_empty_ones(spark, labels):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y z"), (3, "b", None)], "doc_id long, source string, text string")
    got = audit.audit(df, "doc_id", "source", "text", labels, "doc_id", "quality", "toxic")
    assert {(r.part, r.removed + r.kept + r.redundant) for r in got.where("step = 1").collect()} == {("", 2), ("b", 1)}


def test_empty_table(no_docs, labels):
    assert audit.audit(no_docs, "doc_id", "source", "text", labels, "doc_id", "quality", "toxic").count() == 0


@pytest.mark.parametrize("numbers", [[], [0], [0, 255, 3], [256, 0], [65536, 1, 70000], [(1 << 24) + 5, 7, (1 << 31) - 1]])
def test_planes_round_trip(numbers):
    data = audit.planes(np.array(numbers, np.int32))
    assert audit.from_planes(data, len(numbers)).tolist() == numbers
    assert len(data) == len(numbers) * max(1, -(-max(numbers, default=0).bit_length() // 8))
