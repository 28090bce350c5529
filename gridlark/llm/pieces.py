"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding starts from the characters of the normalized text and keeps an agenda of adjacent pairs of symbols whose joined
text is a piece, ordered by the piece's score and then by place; it merges the first pair, adds the pairs that the new
symbol makes with its neighbours, and goes on until none is left.  A symbol that is no piece becomes its UTF-8 bytes'
pieces if the model has them, else the unknown piece.

No merge crosses a place between two characters that don't occur side by side in any piece, so texts are cut there and
the agenda runs once for each different part that a task meets (``KEPT_PARTS`` are remembered at a time).  The agendas of
many short parts advance together, each by its first pair; a long part has a heap of its own.  In each slice
of an Arrow batch, one whole text is encoded by the sentencepiece library too; a difference raises an error.
Normalization and decoding are the library's own.

A null text counts as empty and has no ids; null ids decode to an empty text.  Repeated rows are each encoded.  An empty
table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

KEPT_PARTS = 200_000
# Bytes of text that are encoded at once.
STEP_BYTES = 2 << 20
# Parts of more bytes have a heap of their own.
SHORT = 128
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Pieces of a model, and which characters occur side by side in one."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(len(library))
        self.unknown = library.unk_id()
        plain = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        self.score = {library.id_to_piece(i): library.get_score(i) for i in plain}
        self.id = {library.id_to_piece(i): i for i in ids if not library.is_byte(i)}
        self.unused = {library.id_to_piece(i) for i in plain if library.is_unused(i)}
        self.byte = {int(library.id_to_piece(i)[3:5], 16): i for i in ids if library.is_byte(i)}
        joined = sorted({c for piece in self.score if len(piece) > 1 for c in piece})
        place = {c: k for k, c in enumerate(joined, 1)}  # 0: no piece joins it to another
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in joined]] = np.arange(1, len(joined) + 1)
        self.beside = np.zeros((len(joined) + 1, len(joined) + 1), bool)
        for piece in self.score:
            for a, b in zip(piece, piece[1:]):
                self.beside[place[a], place[b]] = True

        # symbols as numbers: pieces and the characters in them; last, any other character
        names = [*self.score, *sorted({c for piece in self.score for c in piece} - self.score.keys())]
        number = {name: k for k, name in enumerate(names)}
        self.number = np.full(0x110000, len(names), np.int32)
        single = [c for c in names if len(c) == 1]
        self.number[[ord(c) for c in single]] = [number[c] for c in single]
        self.ids = np.array([self.id.get(name, -1) for name in names] + [-1], np.int32)
        scores = np.array([-s for s in self.score.values()])
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int32)  # equal scores share one
        halves = (
            (number[piece[:k]] * len(names) + number[piece[k:]], number[piece])
            for piece in self.score for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number
        )
        found = np.array(sorted(halves), np.int64).reshape(-1, 2)
        self.pair, self.joined, self.names = found[:, 0], found[:, 1].astype(np.int32), len(names)

    def _join(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and rank of joined neighbours; no rank where they don't make a piece."""
        key = left.astype(np.int64) * self.names + right
        key[(left >= self.names) | (right >= self.names)] = -1
        at = np.minimum(np.searchsorted(self.pair, key), max(len(self.pair) - 1, 0))
        if not len(self.pair):
            return np.zeros(len(key), np.int32), np.full(len(key), _NONE, np.int32)
        symbol = self.joined[at]
        return symbol, np.where(self.pair[at] == key, self.rank[symbol], _NONE)

    def encode_many(self, raw: bytes, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts that start at the bytes ``cut`` (one more entry at the end), and how many each has."""
        parts = len(cut) - 1
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        byte = np.r_[np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw)]
        first = np.searchsorted(byte, cut)
        symbol = self.number[codes]
        place = np.arange(len(codes))
        part = np.repeat(np.arange(parts), np.diff(first))
        done: list[tuple[np.ndarray, ...]] = []
        # with each symbol, what it makes with the one after it
        new, rank = np.zeros(len(codes), np.int32), np.full(len(codes), _NONE, np.int32)
        if len(codes) > 1:
            new[:-1], rank[:-1] = self._join(symbol[:-1], symbol[1:])
        rank[first[1:][np.diff(first) > 0] - 1] = _NONE
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(rank)), starts)
            going = best >> 32 != _NONE
            stay = np.repeat(going, np.diff(np.r_[starts, len(symbol)]))
            done.append((part[~stay], place[~stay], symbol[~stay]))
            if not going.any():
                break
            at = best[going] & 0xFFFFFFFF
            symbol[at] = new[at]
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            symbol, place, part, new, rank = (x[stay] for x in (symbol, place, part, new, rank))
            at = moved[at]
            for i in (at - 1, at):
                ok = (i >= 0) & (i + 1 < len(symbol))
                i = i[ok]
                same = part[i] == part[i + 1]
                rank[i[~same]] = _NONE
                i = i[same]
                new[i], rank[i] = self._join(symbol[i], symbol[i + 1])
            rank[-1] = _NONE
        part, place, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        part, place, symbol = part[order], place[order], symbol[order]
        ids = self.ids[symbol]
        unknown = ids < 0
        count = np.where(unknown & bool(self.byte), byte[place + 1] - byte[place], 1)
        out = np.repeat(np.where(unknown, self.unknown, ids), count)
        if self.byte and unknown.any():
            of_byte = np.array([self.byte[b] for b in range(256)], np.int32)
            spelled = np.repeat(unknown, count)
            offset = np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count)
            out[spelled] = of_byte[np.frombuffer(raw, np.uint8)[(np.repeat(byte[place], count) + offset)[spelled]]]
        return out, np.bincount(part, count, parts).astype(np.int64)

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """Whether no merge can cross into each character from the one before."""
        kind = self.kind[codes]
        out = np.ones(len(codes), bool)
        out[1:] = ~self.beside[kind[:-1], kind[1:]]
        return out

    def encode(self, part: str) -> list[int]:
        """Ids of a normalized text, by the agenda."""
        score = self.score
        symbol: list[str] = list(part)
        n = len(symbol)
        if n == 1:
            return self._ids(part)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            s = score.get(symbol[i] + symbol[i + 1])
            if s is not None:
                agenda.append((-s, i, i + 1, 2))
        heapify(agenda)
        halves: dict[str, tuple[str, str]] = {}
        while agenda:
            _, i, j, size = heappop(agenda)
            left, right = symbol[i], symbol[j]
            if not left or not right or len(left) + len(right) != size or after[i] != j:
                continue  # one of them has been merged since
            new = left + right
            if new in self.unused:
                halves[new] = (left, right)
            symbol[i], symbol[j] = new, ""
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                s = score.get(new + symbol[k])
                if s is not None:
                    heappush(agenda, (-s, i, k, size + len(symbol[k])))
            h = before[i]
            if h >= 0:
                s = score.get(symbol[h] + new)
                if s is not None:
                    heappush(agenda, (-s, h, i, size + len(symbol[h])))
        out: list[int] = []
        for s in symbol:
            if s:
                out += self._ids(s, halves)
        return out

    def _ids(self, symbol: str, halves: dict | None = None) -> list[int]:
        found = self.id.get(symbol)
        if found is None:
            if not self.byte:
                return [self.unknown]
            return [self.byte[b] for b in symbol.encode()]
        if halves and symbol in halves:  # an unused piece is taken apart again
            return [i for half in halves[symbol] for i in self._ids(half, halves)]
        return [found]


class Encoder:
    """Ids of whole texts; ids of parts that recur are kept."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes, self.ids = array("I"), array("i")

    def learn(self, new: list[bytes]) -> None:
        """Keeps the ids of new parts."""
        vocabulary = self.vocabulary
        alone = [p for p in new if len(p) > SHORT or vocabulary.unused]
        short = [p for p in new if not (len(p) > SHORT or vocabulary.unused)]
        for part in alone:
            ids = vocabulary.encode(part.decode())
            self.known[part] = len(self.sizes)
            self.sizes.append(len(ids))
            self.ids.extend(ids)
        if short:
            ids, sizes = vocabulary.encode_many(b"".join(short), np.cumsum([0, *map(len, short)]))
            self.known.update(zip(short, range(len(self.sizes), len(self.sizes) + len(short))))
            self.sizes.extend(sizes.tolist())
            self.ids.extend(ids.tolist())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each starts (one more entry at the end)."""
        vocabulary = self.vocabulary
        normal = [vocabulary.library.normalize(t) for t in texts]
        codes = np.frombuffer("".join(normal).encode("utf-32-le"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        at = np.cumsum([0, *map(len, normal)])
        cut = vocabulary.cuts(codes)
        cut[at[:-1][at[:-1] < len(codes)]] = True
        starts = np.flatnonzero(cut)
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        byte = np.r_[0, np.cumsum(width, dtype=np.int64)]
        buffers = [None, pa.py_buffer(byte[np.r_[starts, len(codes)]]), pa.py_buffer("".join(normal).encode())]
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        raw, ends = common.utf8(parts.dictionary)
        raw, ends = raw.tobytes(), ends.tolist()
        distinct = [raw[a:b] for a, b in zip(ends, ends[1:])]
        if len(self.known) > KEPT_PARTS:
            self.forget()
        known = self.known
        self.learn([p for p in distinct if p not in known])
        place = np.array([known[p] for p in distinct], np.int32)[parts.indices.to_numpy()]
        sizes = np.frombuffer(self.sizes, np.uint32).astype(np.int64)
        n = sizes[place]
        ends = np.cumsum(n)
        shift = (np.cumsum(sizes) - sizes)[place] - (ends - n)
        ids = np.frombuffer(self.ids, np.int32)[np.arange(ends[-1]) + np.repeat(shift, n)]
        first = np.r_[0, ends][np.searchsorted(starts, at)]
        self.check(texts, ids, first)
        return ids, first

    def check(self, texts: list[str], ids: np.ndarray, first: np.ndarray) -> None:
        """Holds one text of these, another for each number of texts, against the library."""
        i = len(ids) % len(texts)
        own = ids[first[i] : first[i + 1]].tolist()
        if own != self.vocabulary.library.encode(texts[i]):
            raise ValueError(f"the library encodes a text otherwise: {texts[i][:200]!r}")


def _sent(df: DataFrame, model: str):
    with open(model, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file


def encoded(df: DataFrame, text: str, model: str) -> Column:
    """The ids of each whole text.  ``model``: a file of the sentencepiece library, read on the driver."""
    common.small_batches(df.sparkSession)
    sent = _sent(df, model)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(sent.value)
        for column in batches:
            parts = []
            for a, b in common.slices(column, STEP_BYTES):
                ids, first = encoder(column.slice(a, b - a).to_pylist())
                parts.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return run(common.text_of(df, text))


def decoded(df: DataFrame, ids: str, model: str) -> Column:
    """The text of each list of ids."""
    sent = _sent(df, model)

    @F.arrow_udf(T.StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=sent.value)
        for column in batches:
            yield pa.array([library.decode(x.values.to_pylist()) if x.is_valid else "" for x in column], pa.string())

    return run(df[f"`{ids}`"])


def digests(df: DataFrame, doc_id: str, text: str, model: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (decimal, joined by commas) and of the text decoded from them."""
    rows = df.select(df[f"`{doc_id}`"].alias("doc_id"), encoded(df, text, model).alias("ids"))
    rows = rows.withColumn("decoded", decoded(rows, "ids", model))
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
