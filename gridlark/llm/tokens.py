"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

A folder holds, for each part P of the documents in ascending order of their id,

* ``tokens-P.bin``   ids of all its documents end to end, little-endian, 16 bits wide if the vocabulary allows, else 32;
* ``docs-P.bin``     its document ids, 64 bits each (a null id as 0; nulls come first and are counted in the manifest);
* ``offsets-P.bin``  where each document starts among the ids of *all* documents, 64 bits, one more entry at the end;
* ``manifest``       a Parquet table: part, documents, null ids, ids, base.

Writing takes two steps.  The first encodes each part and counts its ids; prefix sums over these counts give the parts'
bases; the second adds a part's base to its own offsets.  Each file is written under a name of its own and renamed when
whole, so tasks can run again.  Readers map the files into memory where the folder is a local path.

Null texts count as empty and have the end id alone.  Documents with equal ids follow each other, ordered by a hash of
their texts; equal rows all stay.  An empty table gives no parts.  Columns besides id and text are not read.
"""

from __future__ import annotations

import gc
import json
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Bytes of text in a part, about: larger parts have fewer words to encode that other parts encode too.
PART_BYTES = 128 << 20
# Bytes of text encoded at once.
STEP_BYTES = 16 << 20
# Different pieces whose ids a task keeps at a time.
KEPT_PIECES = 500_000

MANIFEST = "part int, n_docs long, n_null long, n_tokens long, width int, base long"


# --- splitting at places where byte-level pre-tokenization always splits -----------------------------------------


def can_split(spec: dict) -> bool:
    """Whether ``pieces`` keeps the ids of this tokenizer: byte-level with the usual pattern, texts taken as they are."""
    before = spec.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    added = all(re.fullmatch(r"[<|a-z>_]+", t["content"]) and not t["lstrip"] for t in spec.get("added_tokens", []))
    return bool(plain and added and not spec.get("normalizer") and not spec.get("post_processor"))


# ASCII punctuation that neither starts a contraction nor occurs in a special token
MARKS = rb"""!"#$%&()*+,-./:;=?@[\]^`{}~"""


def _classes() -> np.ndarray:
    """For each byte the sum of its classes."""
    b = np.arange(256)
    letter = (b | 0x20 >= 0x61) & (b | 0x20 < 0x7B) & (b < 0x80)
    groups = {
        _END: (b > 0x20) & (b < 0x7F),
        _TWO: (b >= 0xC3) & (b <= 0xDF),
        _REST: (b >= 0x80) & (b < 0xC0),
        _MARK: np.isin(b, list(MARKS)),
        _ALNUM: letter | (b >= 0x30) & (b < 0x3A),
        _SPACE: b == 0x20,
        _FEED: b == 0x0A,
    }
    return sum(np.where(of, bit, 0) for bit, of in groups.items()).astype(np.uint8)


_END, _TWO, _REST, _MARK, _ALNUM, _SPACE, _FEED = (1 << i for i in range(7))


def pieces(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Starts of pieces that can be encoded alone (rows start at ``at``).

    The pattern splits before a single space or line feed between two characters that aren't white space, after such a
    line feed, and between an ASCII letter or digit and one of ``MARKS``.
    Only ASCII and two-byte characters from U+00C0 up are taken for certain not to be white space.
    """
    n = len(data)
    kind = np.zeros(n + 3, np.uint8)  # kind[i + 2] is that of byte i
    kind[2:-1] = _classes()[data]
    own, back, next_ = kind[2:-1], kind[1:-2], kind[3:]
    ends = back & _END  # a character that isn't white space ends just before
    ends |= (back & _REST != 0) & (kind[:-3] & _TWO != 0)
    begins = next_ & (_END | _TWO)
    lone = (ends != 0) & (begins != 0)
    inner = at[(at > 0) & (at < n)]
    lone[inner] = False  # both neighbours must be in its own row
    lone[inner - 1] = False
    feed = lone & (own & _FEED != 0)
    cut = np.zeros(n + 1, bool)
    cut[:-1] = lone & (own & _SPACE != 0) | feed | (own & _MARK != 0) & (back & _ALNUM != 0)
    cut[1:] |= feed
    cut[at] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Ids of texts, by the tokenizers library; ids of pieces that recur are kept."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.splits = can_split(json.loads(spec))
        # the 256 characters that stand for bytes in a byte-level vocabulary: printable ones for themselves
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes = array("I")
        self.ids = array("I")

    def single(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each piece is one pre-token for certain: a space or none, then only letters, digits or ``MARKS``."""
        kind = _classes()[data]
        latin = np.zeros(len(data) + 1, bool)  # both bytes of À to ÿ without × and ÷
        latin[:-1][data == 0xC3] = True
        latin[:-1][:-1] &= ~np.isin(data[1:], [0x97, 0xB7])
        latin[1:] |= latin[:-1]
        letter = (kind & _ALNUM != 0) & (data > 0x39) | latin[:-1]
        skip = at[:-1] + (data[np.minimum(at[:-1], len(data) - 1)] == 0x20)
        whole = np.zeros(len(at) - 1, bool)
        for run in (letter, (kind & _ALNUM != 0) & (data <= 0x39), kind & _MARK != 0):
            so_far = np.r_[0, np.cumsum(run)]
            whole |= so_far[at[1:]] - so_far[skip] == at[1:] - skip
        return whole & (at[1:] > skip)

    def learn(self, single: list[bytes], mixed: list[bytes]) -> None:
        """Keeps the ids of new pieces: single pre-tokens go to the model, others through the whole tokenizer."""
        tokenize = self.tokenizer.model.tokenize
        for a in range(0, len(single), 10_000):
            some = single[a : a + 10_000]
            ends = list(accumulate(map(len, some), initial=0))
            joined = b"".join(some).decode("latin-1").translate(self.letters)
            found = [tokenize(joined[i:j]) for i, j in zip(ends, ends[1:])]
            self._keep(some, map(len, found), [t.id for tokens in found for t in tokens])
        found = [e.ids for e in self.tokenizer.encode_batch([x.decode() for x in mixed], add_special_tokens=False)]
        self._keep(mixed, map(len, found), [i for ids in found for i in ids])

    def _keep(self, some: list[bytes], sizes: Iterable[int], ids: list[int]) -> None:
        self.known.update(zip(some, range(len(self.sizes), len(self.sizes) + len(some))))
        self.sizes.extend(sizes)
        self.ids.extend(ids)

    def __call__(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and how many each row has."""
        rows = len(at) - 1
        if not self.splits:
            texts = [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])]
            lists = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64)
        starts = pieces(data, at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        ends = np.r_[starts, len(data)]
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        raw, cuts = common.utf8(column.dictionary)
        single = self.single(raw, cuts).tolist()
        raw, cuts = raw.tobytes(), cuts.tolist()
        distinct = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(self.known) > KEPT_PIECES:
            self.forget()
        known, new = self.known, ([], [])
        for piece, alone in zip(distinct, single):
            if piece not in known:
                new[not alone].append(piece)
        self.learn(*new)
        place = np.array([known[p] for p in distinct], np.int32)[column.indices.to_numpy()]
        sizes = np.frombuffer(self.sizes, np.uint32).astype(np.int64)
        n = sizes[place]
        ends = np.cumsum(n)
        shift = (np.cumsum(sizes) - sizes)[place] - (ends - n)
        ids = np.frombuffer(self.ids, np.uint32)[np.arange(ends[-1]) + np.repeat(shift, n)]
        of_rows = np.r_[0, ends][np.searchsorted(starts, at)]
        return ids, np.diff(of_rows)


# --- writing and reading -----------------------------------------------------------------------------------------


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _place(files: fs.FileSystem, written: str, name: str) -> None:
    """Renames a whole file, unless an earlier attempt has left the same."""
    if files.get_file_info(name).type == fs.FileType.NotFound:
        files.move(written, name)
    else:
        files.delete_file(written)


def _encode(spec: str, end_id: int, width: int, folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        gc.disable()  # many short-lived tokens, no cycles
        part = TaskContext.get().partitionId()
        encoder, (files, top), own = None, _open(folder), uuid.uuid4().hex
        files.create_dir(top, recursive=True)
        n_docs = n_null = n_tokens = 0
        out = {}
        for batch in batches:
            texts = batch.column(1)
            for a, b in common.slices(texts, STEP_BYTES):
                if encoder is None:
                    encoder = Encoder(spec)
                    out = {k: files.open_output_stream(f"{top}/{k}-{part:06d}.{own}") for k in ("tokens", "docs", "sizes")}
                ids, sizes = encoder(*common.utf8(texts.slice(a, b - a)))
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                docs = batch.column(0).slice(a, b - a)
                out["tokens"].write(ids.astype(f"<u{width}").tobytes())
                out["sizes"].write((sizes + 1).astype("<i8").tobytes())
                out["docs"].write(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_null, n_tokens = n_docs + b - a, n_null + docs.null_count, n_tokens + len(ids)
        gc.enable()
        for k, stream in out.items():
            stream.close()
            _place(files, f"{top}/{k}-{part:06d}.{own}", f"{top}/{k}-{part:06d}.bin")
        if n_docs:
            row = {"part": part, "n_docs": n_docs, "n_null": n_null, "n_tokens": n_tokens, "width": width}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), *((k, pa.int64()) for k in ("n_docs", "n_null", "n_tokens")), ("width", pa.int32())]))

    return run


def _rebase(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{top}/sizes-{row['part']:06d}.bin") as f:
                    sizes = np.frombuffer(f.read(), "<i8")
                name = f"{top}/offsets-{row['part']:06d}"
                with files.open_output_stream(written := f"{name}.{uuid.uuid4().hex}") as f:
                    f.write((row["base"] + np.r_[0, np.cumsum(sizes)]).astype("<i8").tobytes())
                _place(files, written, f"{name}.bin")
            yield batch

    return run


def write_tokens(
    df: DataFrame, doc_id: str, text: str, folder: str, tokenizer: str, end_id: int, part_bytes: int = PART_BYTES
) -> None:
    """Encodes all texts, in ascending order of ``doc_id``, into the file format above.

    ``tokenizer``: a file of the tokenizers library, read on the driver; ``end_id`` follows each document.
    """
    spark = df.sparkSession
    common.small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer

    ids = max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1)
    texts = df.select(df[f"`{doc_id}`"].cast("bigint").alias("doc_id"), common.text_of(df, text).alias("text"))
    n = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-n // part_bytes))
    keys = ["doc_id", F.xxhash64("text")]
    dealt = texts.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    own = MANIFEST.rsplit(",", 1)[0]
    dealt.mapInArrow(_encode(spec, end_id, 2 if ids <= 1 << 16 else 4, folder), own).write.parquet(f"{folder}/counts")
    before = "coalesce(sum(n_tokens) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS base"
    based = spark.read.schema(own).parquet(f"{folder}/counts").selectExpr("*", before)  # a row for each part
    based.repartition(parts, "part").mapInArrow(_rebase(folder), MANIFEST).write.parquet(f"{folder}/manifest")


def _read(folder: str, with_ids: bool) -> Callable:
    def map_file(files: fs.FileSystem, name: str, kind: str) -> np.ndarray:
        if isinstance(files, fs.LocalFileSystem):
            return np.memmap(name, kind, "r")
        with files.open_input_file(name) as f:
            return np.frombuffer(f.read(), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                part = f"-{row['part']:06d}.bin"
                tokens = map_file(files, f"{top}/tokens{part}", f"<u{row['width']}")
                starts = map_file(files, f"{top}/offsets{part}", "<i8")
                docs = map_file(files, f"{top}/docs{part}", "<i8")
                assert len(docs) + 1 == len(starts) == row["n_docs"] + 1, f"{part} is not whole"
                assert len(tokens) == starts[-1] - row["base"] == row["n_tokens"], f"{part} is not whole"
                local = starts - row["base"]
                for a in range(0, len(docs), common.BATCH_ROWS):
                    b = min(a + common.BATCH_ROWS, len(docs))
                    each = [tokens[i:j].astype("<u4") for i, j in zip(local[a:b], local[a + 1 : b + 1])]
                    out = {
                        "doc_id": pa.array(docs[a:b], mask=np.arange(a, b) < row["n_null"]),
                        "start": pa.array(starts[a:b]),
                        "n_tokens": pa.array(np.diff(local[a : b + 1])),
                        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of such a folder: doc_id, start, n_tokens, ids_crc32 (and the ids, if asked for)."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return manifest.repartition(common.partitions(spark), "part").mapInArrow(_read(folder, with_ids), schema)
