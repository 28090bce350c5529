import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridlark.llm import common, tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_keep_the_ids():
    with open(FILE, encoding="utf-8") as f:
        encoder = tokens.Encoder(f.read())
    assert encoder.splits
    rng = np.random.default_rng(5)
    parts = ["***", "42", "|", "<", "_", "Ã", "-", '"', " ", "\n", "a", "Z", ",", ".", "!", "'", "s", "é", " ",
             "　", "—", "中", "\u0085", "<|endoftext|>", "\t", "the", "'ll", "×", "\x1c", "٠", "\r"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(4000)]
    ids, sizes = encoder(*common.utf8(pa.array(texts)))
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("part_bytes", [1 << 27, 50_000])
def test_files_hold_every_document(spark, docs, rows, tmp_path, part_bytes):
    folder = f"file://{tmp_path}/out"
    tokens.write_tokens(docs, "doc_id", "text", folder, FILE, 2, part_bytes)
    found = tokens.read_tokens(spark, folder, with_ids=True).orderBy("start").collect()
    library = Tokenizer.from_file(FILE)
    want = sorted((r[0] is not None, r[0] or 0, tuple(library.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, tuple(r.ids)) for r in found) == want
    assert [r.doc_id is not None for r in found] == sorted(r.doc_id is not None for r in found)
    assert [r.doc_id for r in found if r.doc_id is not None] == sorted(r.doc_id for r in found if r.doc_id is not None)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_tokens == len(r.ids) for r in found)
    # flat 16-bit files, end to end
    parts = sorted((tmp_path / "out").glob("tokens-*.bin"))
    assert sum(p.stat().st_size for p in parts) == 2 * sum(r.n_tokens for r in found)


def test_empty_table(spark, no_docs, tmp_path):
    tokens.write_tokens(no_docs, "doc_id", "text", f"file://{tmp_path}/out", FILE, 2)
    assert tokens.read_tokens(spark, f"file://{tmp_path}/out").count() == 0


def test_other_tokenizers_encode_whole_texts(spark, docs, rows, tmp_path):
    file = public_tokenizers.path("word_bpe_49k.json")
    tokens.write_tokens(docs, "doc_id", "text", f"file://{tmp_path}/out", file, 49407)
    found = tokens.read_tokens(spark, f"file://{tmp_path}/out").collect()
    library = Tokenizer.from_file(file)
    assert sorted(r.n_tokens for r in found) == sorted(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
