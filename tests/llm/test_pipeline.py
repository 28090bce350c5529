from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_mixing import filled
from test_rules import measured
from test_simhash import classes, fingerprint

from gridlark.llm import mixing
from gridlark.session import stored


def test_stages_against_brute_force(spark):
    """Each stage on its own input, over the smallest tables."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        docs = stored(stage(spark, docs, sf))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    raw, clean, good, single, mix = (d.collect() for d in seen)
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    gone = {r.doc_id for r in raw} - {r.doc_id for r in clean}
    assert gone and len(gone - toxic) <= 0.1 * len(raw)

    def ok(text):
        n, chars, symbols, dup, repeat, lines, exclaims, stutters = measured(text or "")
        bad = n < 20 or 100 * repeat > 30 * n or dup > 3 and 100 * dup > 30 * lines or 100 * symbols > 5 * chars
        return not (bad or 100 * stutters > 30 * n or 100 * exclaims > 60 * n or chars < 2 * n or chars > 20 * n)

    assert sorted(good) == sorted(r for r in clean if ok(r.text))
    groups = {}
    for r, root in zip(good, classes([fingerprint(r.text or "") for r in good])):
        groups[root] = min(groups.get(root, r), r, key=lambda x: x.doc_id)
    assert sorted(single) == sorted(groups.values())
    sizes = Counter()
    for r in single:
        sizes[r.source] += len(r.text.split())
    want = filled(sizes, mixing.WEIGHTS)
    taken = Counter()
    for r in mix:
        taken[r.source] += len(r.text.split())
    for s in want:
        assert abs(taken[s] - want[s]) <= max(len(r.text.split()) for r in single if r.source == s)
    assert set(Counter(mix).values()) <= {1, 2} and set(mix) <= set(single)
    assert Counter(r.doc_id for r in mix) == Counter(r.doc_id for r in docs.collect())


def test_run_is_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 20


@pytest.mark.parametrize("stage", [s for n, s in corpus_pipeline.STAGES[1:]])
def test_stages_on_odd_rows(spark, docs, no_docs, stage):
    out = stage(spark, docs, "")
    assert out.where(F.lit(True)).count() >= 1
    assert stage(spark, no_docs, "").count() == 0
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns
