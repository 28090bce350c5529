from collections import Counter

import numpy as np
import pytest

from gridlark.llm import mixing


def filled(sizes, weights, share=1.5, most=2.0):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, done = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in done]
        each = {s: (budget - sum(done.values())) * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if each[s] > most * sizes[s]]
        if not above:
            return {**done, **each}
        done |= {s: most * sizes[s] for s in above}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        source = [None, "a", "b", "é", "Z", "hot", "hot", "hot"][i % 8]
        rows.append((i, " w" * int(rng.integers(0, 60)), source, "x"))
    rows += [rows[9]] * 50 + [(None, None, "hot", "y"), (None, "a b", None, "y")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, copies string").cache()


@pytest.mark.parametrize("group", [64, 4096])
def test_targets_are_met(table, group):
    rows, df = table
    got = mixing.mixed(df, "doc_id", "source", "text", group=group).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    want = filled(sizes, mixing.WEIGHTS)
    taken = Counter()
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r.size <= 2 * r.size
        assert r.copies - r.target / r.source_size < 1 and r.target / r.source_size - r.copies < 1
        taken[r.source] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) < 60  # the largest document


def test_runs_agree_and_seeds_differ(table):
    _, df = table
    run = lambda seed, n: sorted((r.doc_id or -1, r.source or "", r.taken) for r in mixing.mixed(df.repartition(n), "doc_id", "source", "text", seed, group=64).collect())
    assert run(0, 2) == run(0, 5) != run(1, 2)


def test_pivot_keeps_words_and_chances():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 40).astype(float)
    p = rng.random(40)
    mean = np.zeros(40)
    for _ in range(4000):
        out = mixing.pivot(p, size, rng.random(40))
        open_ = (out > 0) & (out < 1)
        assert open_.sum() <= 1 and abs((out * size).sum() - (p * size).sum()) < 1e-6
        mean += out
    assert np.abs(mean / 4000 - p).max() < 0.04


def test_taken_rows_keep_the_columns(docs, rows):
    got = mixing.taken(docs, "doc_id", "source", "text")
    assert got.schema == docs.schema
    copies = Counter((r.doc_id, r.text) for r in got.collect())
    decided = Counter()
    for r in mixing.mixed(docs, "doc_id", "source", "text").collect():
        decided[r.doc_id, r.text] += r.copies
    assert copies == +decided


def test_degenerate_tables(spark, no_docs):
    assert mixing.mixed(no_docs, "doc_id", "source", "text").count() == 0
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.taken) for r in mixing.mixed(df, "doc_id", "source", "text").collect()] == [(0, 0), (0, 0)]
