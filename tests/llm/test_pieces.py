import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from gridlark.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "a", "b", "Z", "9", ",", ".", "the", "ing", "é", "ß", "\xa0", "　", "—", "中", "▁", "<s>", "</s>",
         "<unk>", "<0x41>", "\t", "\U0001f600", "\x00", "ﬁ", "supercalifragilistic"]


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as f:
        return pieces.Encoder(f.read())


def test_ids_are_the_library_s(encoder):
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(PARTS, rng.integers(0, 25))) for _ in range(5000)]
    ids, first = encoder(texts)
    want = encoder.vocabulary.library.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == want


def test_heap_and_shared_agendas_agree(encoder):
    vocabulary, rng = encoder.vocabulary, np.random.default_rng(9)
    texts = ["".join(rng.choice(PARTS, rng.integers(1, 30))) for _ in range(2000)]
    raw = [vocabulary.library.normalize(t).encode() for t in texts]
    ids, sizes = vocabulary.encode_many(b"".join(raw), np.cumsum([0, *map(len, raw)]))
    at = np.r_[0, np.cumsum(sizes)]
    for i, part in enumerate(raw):
        assert ids[at[i] : at[i + 1]].tolist() == vocabulary.encode(part.decode())


def test_long_parts(encoder):
    for text in ("a" * 100_000, "\U0001f600" * 5000, " " * 3001, "ab" * 4000):
        ids, _ = encoder([text, "x"])
        assert ids.tolist() == [i for t in (text, "x") for i in encoder.vocabulary.library.encode(t)]


def test_a_difference_raises(encoder):
    with pytest.raises(ValueError, match="otherwise"):
        encoder.check(["some text"], np.array([5, 6]), np.array([0, 2]))


def test_table(docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "")
        joined, text = ",".join(map(str, ids)), library.decode(ids)
        want[r[0], len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, text))] += 1
    assert Counter(tuple(r) for r in pieces.digests(docs, "doc_id", "text", MODEL).collect()) == want


def test_decoding_nulls_and_empty_table(spark, no_docs):
    df = spark.createDataFrame([(None,), ([],), ([450, 29871],)], "ids array<int>")
    assert [r[0] for r in df.select(pieces.decoded(df, "ids", MODEL)).collect()][:2] == ["", ""]
    assert pieces.digests(no_docs, "doc_id", "text", MODEL).where(F.lit(True)).count() == 0
