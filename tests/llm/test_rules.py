import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridlark.llm import common, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(lines), text.count("!"), sum(a == b for a, b in zip(words, words[1:])),
    )


def test_measurements(docs, rows):
    got = rules.ledger(docs, "text").select("doc_id", *rules.MEASURES, "fails").collect()
    want = Counter((r[0], *measured(r[1] or "")) for r in rows)
    assert Counter(tuple(r)[:-1] for r in got) == want
    for r in got:
        n, chars, symbols, dup, repeat, lines, exclaims, stutters = tuple(r)[1:-1]
        bits = [n < 20, 100 * repeat > 30 * n, dup > 3 and 100 * dup > 30 * lines, 100 * symbols > 5 * chars,
                100 * exclaims > 60 * n, chars < 2 * n or chars > 20 * n, 100 * stutters > 30 * n]
        assert r.fails == sum(1 << i for i, b in enumerate(bits) if b)


def test_slices_keep_measurements(docs):
    whole = sorted(tuple(r) for r in rules.ledger(docs, "text").select(*rules.MEASURES).collect())
    texts = pa.array([r.text or "" for r in docs.collect()])
    parts = [rules.measure(*common.utf8(texts.slice(a, b - a))) for a, b in common.slices(texts, 500)]
    assert len(parts) > 5
    columns = [np.concatenate([p[m] for p in parts]).tolist() for m in rules.MEASURES]
    assert sorted(zip(*columns)) == whole


def test_policies_and_ablations(spark, docs):
    entries = rules.ledger(docs, "text").select("fails").cache()
    bits = [r.fails for r in entries.collect()]
    for policy in rules.POLICIES.values():
        mask = rules.mask(policy)
        assert entries.where(rules.passes(policy)).count() == sum(not b & mask for b in bits)
        got = {r.rule: tuple(r)[1:] for r in rules.ablations(entries, policy).collect()}
        for name in policy:
            bit = rules.mask([name])
            assert got[name] == (
                sum(b & bit > 0 for b in bits), sum(b & mask == bit for b in bits), sum(not b & mask & ~bit for b in bits)
            )


def test_filter_keeps_the_columns(docs, rows):
    kept = rules.filtered(docs, "text", rules.POLICIES["base"])
    assert kept.schema == docs.schema
    ok = Counter()
    for r in rows:
        n, *_, repeat, _, _, _ = measured(r[1] or "")
        ok[r[0]] += n >= 20 and 100 * repeat <= 30 * n
    assert Counter(r.doc_id for r in kept.collect()) == +ok


def test_empty_table(no_docs):
    entries = rules.ledger(no_docs, "text")
    assert entries.count() == 0
    assert [tuple(r)[1:] for r in rules.ablations(entries, ["few_words"]).collect()] == [(0, 0, 0)]
    assert rules.filtered(no_docs, "text", ["few_words"]).where(F.lit(True)).count() == 0
