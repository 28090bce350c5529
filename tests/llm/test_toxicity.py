import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridlark.llm import common, toxicity
from gridlark.llm.queries import QUERIES


def coordinates(text):
    index, _ = toxicity.features(*common.utf8(pa.array([text])))
    return set(index.tolist())


def test_features_are_of_words_and_their_neighbours():
    base = coordinates("One two three four")
    assert base == coordinates("  one,TWO;three\nfour!")
    assert coordinates("CAFÉ Ünter") == coordinates("café ünter") != coordinates("cafe unter")
    words = {w: coordinates(w) for w in ("one", "two", "three", "four")}
    assert all(c <= base for c in words.values())
    # four words, two stems of "three" (four bytes) or none, three + two + one pairs
    assert len(base) == 4 + 1 + 3 + 2 + 1
    assert coordinates("loweischaft") & coordinates("loweient")
    assert coordinates("") == coordinates(" !? ") == set()
    both, row = toxicity.features(*common.utf8(pa.array(["a b", "c"])))
    assert len(both) == 4 and row.tolist().count(1) == 1  # no pair across rows


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(0)
    examples = []
    for i in range(2000):
        label = int(i % 4 == 0)
        index = rng.choice(5000, 60, replace=False) + 10
        examples.append((label, np.unique(np.r_[index, 1 + rng.integers(0, 3)] if label else index).astype(np.int32)))
    model = toxicity.fit(examples[:1500])
    table = model.dense()
    scores = [1 / (1 + np.exp(-(table[i].sum() + model.bias))) for _, i in examples[1500:]]
    labels = [y for y, _ in examples[1500:]]
    assert np.mean([(s >= 0.5) == y for s, y in zip(scores, labels)]) > 0.97
    assert {1, 2, 3} <= set(model.index.tolist()) and len(model.index) < 1500


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op4_ftrl_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    positive = [r.score for r in got if r.toxic]
    negative = [r.score for r in got if not r.toxic]
    auc = np.mean([(np.array(negative) < s).mean() for s in positive])
    assert auc > 0.95
    assert sum(r.predicted and not r.toxic for r in got) <= 0.01 * len(negative)
    assert sum(r.predicted for r in got if r.toxic) > 0.6 * len(positive)


def test_labels_of_held_out_rows_don_t_matter(spark, docs):
    labels = [(i, int(i % 3 == 0)) for i in range(50)] + [(None, 1), (3, None), (4, 1), (4, 0)]
    out = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(100)]
    other = [(i, 1 - y) if i is not None and y is not None and out[i] else (i, y) for i, y in labels]
    models = []
    for rows in (labels, other):
        df = spark.createDataFrame(rows, "doc_id long, toxic int")
        models.append(toxicity.train(docs, df, "doc_id", "text", "doc_id", "toxic"))
    assert models[0].bias == models[1].bias and (models[0].index == models[1].index).all() and (models[0].weight == models[1].weight).all()
    scored = docs.select("doc_id", "text", toxicity.held_out(F.col("doc_id")).alias("h"), toxicity.scored(docs, "text", models[0]).alias("p")).collect()
    assert all(0 <= r.p <= 1 for r in scored) and all(r.h == (r.doc_id is not None and out[r.doc_id]) for r in scored)
    empty = {r.p for r in scored if not (r.text or "").strip(" \t\n\x0b\x0c\r\x85")}
    assert len(empty) == 1
    kept = toxicity.filtered(docs, "text", models[0], 0.5)
    assert kept.schema == docs.schema and kept.count() == sum(r.p < 0.5 for r in scored)


def test_degenerate_labels(spark, docs, no_docs):
    for rows, want in (([], 0), ([(1, 0), (2, 0)], 0), ([(i, 1) for i in range(20)], 1)):
        df = spark.createDataFrame(rows, "doc_id long, toxic int")
        model = toxicity.train(docs, df, "doc_id", "text", "doc_id", "toxic")
        assert {round(r[0]) for r in docs.select(toxicity.scored(docs, "text", model)).collect()} == {want}
    model = toxicity.train(no_docs, df, "doc_id", "text", "doc_id", "toxic")
    assert no_docs.select(toxicity.scored(no_docs, "text", model)).count() == 0


def test_the_sample_is_bounded(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 10 = 0 AS INT) AS label")
    got = {r.label: r.n for r in toxicity._sampled(df, 300).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 100, 0: 200}
    assert toxicity._sampled(df, 100).groupBy("label").count().where("count = 50").count() == 2


def test_a_bounded_sample_keeps_the_mix_of_the_labels(spark):
    """Texts that tell nothing score the share of toxic labels, however the sample is mixed."""
    df = spark.range(1500).selectExpr("id AS doc_id", "'the same few words' AS text", "CAST(id % 10 = 0 AS INT) AS toxic")
    for rows in (120, 12_000):
        model = toxicity.train(df, df, "doc_id", "text", "doc_id", "toxic", rows=rows)
        got = df.limit(1).select(toxicity.scored(df, "text", model)).first()[0]
        assert 0.02 < got < 0.3, (rows, got)


def test_fit_is_ftrl_coordinate_by_coordinate():
    """The same weights from the update as published, one coordinate after the other over dictionaries."""
    rng = np.random.default_rng(11)
    examples = [(int(i % 3 == 0), np.unique(np.r_[rng.integers(0, 60, 8), 100 + i % 3]).astype(np.int32)) for i in range(240)]
    alpha, beta, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(toxicity.EPOCHS):
        for label, index in examples:
            own = [*index.tolist(), "bias"]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in own:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    model = toxicity.fit(examples)
    want = {i: weight(i) for i in z if i != "bias" and weight(i)}
    got = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert set(got) == set(want) and 0 < len(got) < 63
    assert all(abs(got[i] - want[i]) < 1e-5 for i in want) and abs(model.bias - weight("bias")) < 1e-9


def test_features_against_a_dictionary_of_words():
    """Two texts share as many coordinates as they share words, stems and pairs."""

    def named(text):
        words = re.findall("[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-ZÀ-ÖØ-Þ]", lambda m: m[0].lower(), text))
        raw = [w.encode() for w in words]
        out = {("word", w) for w in raw} | {(k, w[:k]) for k in (4, 5) for w in raw if len(w) > k}
        return out | {(f"gap {g}", a, b) for g in (1, 2, 3) for a, b in zip(raw, raw[g:])}

    texts = ["Élan vital, ÀÞß × naïve naïveté", "the cat sat on the mat the cat sat", "x1 y2\tz3-w4 ... cafés", "", "élan VITAL the naïve cat on x1"]
    for a in texts:
        assert len(coordinates(a)) == len(named(a))
        for b in texts:
            assert len(coordinates(a) & coordinates(b)) == len(named(a) & named(b)), (a, b)
