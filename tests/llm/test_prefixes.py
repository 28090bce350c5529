import hashlib
import json
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridlark.llm import common, prefixes, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def spec():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def vocabulary(spec):
    return prefixes.Vocabulary(spec)


def expected(rows):
    library = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    return out


def encoded(spec, vocabulary, texts, step=1 << 20):
    encoder = prefixes.Encoder(spec, vocabulary)
    column, out = pa.array(texts, pa.large_string()), []
    for a, b in common.slices(column, step):
        ids, first = encoder(*common.utf8(column.slice(a, b - a)))
        out += [ids[i:j].tolist() for i, j in zip(first, first[1:])]
    return out


ODD = [
    "a\x00b \x00 \x1c\x1f", "Ünḯcödé x İstanbul ΑΣ ΑΣ. é x y　z\u0085", "'s'll don't I'M they'RE 1234 </w> a</w> </w",
    "<|ENDOFTEXT|> foo<|endoftext|>bar<|startoftext|><|endoftext|> <|endoftext| >", "aaaa aaaaa aaaaaaa lllll " + "l" * 70 + " " + "ab" * 90,
    "hahahahahahaha " + "!" * 300 + " ____ --- -_- …… 中文字 \U0001f600\U0001f600", "x" * 5000, "é ́a � ﻿b",
]


def test_odd_texts(spec, vocabulary):
    library = Tokenizer.from_file(PATH)
    want = [e.ids for e in library.encode_batch(ODD, add_special_tokens=False)]
    assert encoded(spec, vocabulary, ODD) == want
    assert encoded(spec, vocabulary, ODD, 1) == want


def test_random_words(spec, vocabulary):
    """Few letters, so that many merges compete, and letters of long tokens."""
    rng, library = random.Random(5), Tokenizer.from_file(PATH)
    alphabets = ["ab", "ehln", "tionsaer", "!?.-", "éüñç", "0123", "thisand'"]
    texts = [" ".join("".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 24))) for _ in range(60)) for _ in range(120)]
    assert encoded(spec, vocabulary, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_walk_computes_shared_prefixes_once(spec, vocabulary, monkeypatch):
    stem = "internationalizationofthewholeworld"
    words = [stem[:k] + tail for k in range(5, len(stem)) for tail in ("", "x", "xy")]
    walk, steps = prefixes.Words(vocabulary), []
    ids, sizes = walk(words)
    library = Tokenizer.from_file(PATH)
    ends = np.cumsum(sizes)
    got = [ids[b - n : b].tolist() for b, n in zip(ends, sizes)]
    assert got == [library.encode(w, add_special_tokens=False).ids for w in words]

    class Counted(dict):
        def get(self, *key):
            steps.append(key)
            return dict.get(self, *key)

    walk.grown = Counted(walk.grown)
    walk(words)
    nodes = len({w[:k] for w in words for k in range(1, len(w))}) + len(set(words))
    assert len(steps) == nodes  # one step for each node of the trie, not for each character


def test_forgotten_runs_are_learned_again(spec, vocabulary, monkeypatch):
    monkeypatch.setattr(prefixes, "KEPT_RUNS", 5)
    texts = ["one two three four five six seven", "two eight nine ten one", "", "one one seven <|endoftext|>"]
    library = Tokenizer.from_file(PATH)
    assert encoded(spec, vocabulary, texts, 1) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("change", [
    lambda d: d["model"].update(end_of_word_suffix=None), lambda d: d["model"].update(dropout=0.1),
    lambda d: d.update(decoder={"type": "ByteLevel"}), lambda d: d["model"]["vocab"].pop("!"),
    lambda d: d["model"]["merges"].sort(key=lambda m: -len("".join(m))), lambda d: d["added_tokens"][0].update(lstrip=True),
])
def test_other_tokenizers_are_refused(spec, change):
    d = json.loads(spec)
    change(d)
    with pytest.raises(ValueError):
        prefixes.Vocabulary(json.dumps(d))


def test_documents(docs, rows):
    got = Counter(map(tuple, prefixes.digests(docs, "doc_id", "text", PATH).collect()))
    assert got == Counter(expected([r[:2] for r in rows]))


def test_texts_to_ids_and_back(docs, rows):
    library = Tokenizer.from_file(PATH)
    df = docs.select("doc_id", "text", prefixes.encoded(docs, "text", PATH).alias("own"))
    got = df.select("text", "own", prefixes.decoded(df, "own", PATH).alias("said")).collect()
    want = [library.encode(r[1] or "", add_special_tokens=False).ids for r in rows]
    assert Counter((r.text, tuple(r.own), r.said) for r in got) == Counter(
        (r[1], tuple(ids), library.decode(ids, skip_special_tokens=False)) for r, ids in zip(rows, want)
    )


def test_null_empty_and_foreign_ids(spark):
    df = spark.createDataFrame([(None,), ([],), ([49407, 320],), ([-1, 320, 10**9],)], "ids array<int>")
    got = df.select(prefixes.decoded(df, "ids", PATH).alias("t")).collect()
    assert [r.t for r in got] == ["", "", "<|endoftext|> a</w>", "a</w>"]


def test_empty_table(no_docs):
    assert prefixes.digests(no_docs, "doc_id", "text", PATH).count() == 0


def test_query(spark, sf):
    got = Counter(map(tuple, queries.QUERIES["op11_prefix_trie"](spark, sf).collect()))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == Counter(expected(docs))
