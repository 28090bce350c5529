"""BPE encoding and decoding for vocabularies with word ends, through a trie of words.

The last token of a word's encoding has nothing to do with what follows the word, and what stands before it is encoded as
if it stood alone.  So each prefix has one *last-token state*: the token that ends its encoding, and with it, by what
remains before that token, the whole encoding.  A prefix's state is the one token among its suffixes that *stands* beside
the state of the prefix before it: no merge ever crosses between the two.  Words are put in order, which is a depth-first
walk of their trie; the states of a shared prefix are kept on the path and computed once.  A word's last character is a
symbol of its own (with the mark of the word end), so a word's end is a leaf below the prefix of the other characters.

Whether two tokens stand side by side follows from the ranks: merges go by rank, so a piece at the edge of a token exists
from the rank that forms it to the rank that takes it up; a merge across happens just if its own rank comes while both
its pieces exist (of equal ranks the left one goes first).  That needs each merge to rank after those that form its
parts; a vocabulary in another order raises an error, as does a tokenizer of another kind.

Normalization and pre-tokenization are the library's own.  Runs of characters other than ASCII white space don't depend
on each other there, so each different run is prepared once per task (``KEPT_RUNS`` are remembered at a time).  Added
tokens in a text become their ids, as in the library.  Decoding joins the tokens' strings by spaces, as the library does
for a tokenizer without a decoder.

A null text counts as empty and has no ids; null ids decode to an empty text.  Repeated rows are each encoded.  An empty
table gives an empty result.  Columns besides the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

# Different runs whose ids a task keeps at a time.
KEPT_RUNS = 300_000
# Bytes of text that are encoded at once, and runs of them that are cut out at once.
STEP_BYTES = 4 << 20
STEP_RUNS = 100_000
_NEVER = 1 << 30
# Joins runs that are normalized together; a run that has it is normalized alone.
_BETWEEN = "\x00"


def letters() -> list[str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens by their spelling, and which may follow each other."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model, vocab = d["model"], d["model"]["vocab"]
        end = model.get("end_of_word_suffix")
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        added = d.get("added_tokens") or []
        odd |= any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["content"] or re.search(r"\s", t["content"]) for t in added)
        if model["type"] != "BPE" or not end or odd or d.get("decoder"):
            raise ValueError("a BPE tokenizer with word ends and without a decoder is needed")
        base = [c + e for e in ("", end) for c in letters()]
        if any(c not in vocab for c in base):
            raise ValueError("the vocabulary lacks some bytes")
        self.special = {t["content"]: t["id"] for t in added}
        self.name = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        symbols = {vocab[c]: (vocab[c],) for c in base}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, new = vocab[left], vocab[right], vocab[left + right]
            if a not in symbols or b not in symbols:
                raise ValueError("merges must rank after those that form their parts")
            self.rank[a, b] = rank, new
            symbols.setdefault(new, symbols[a] + symbols[b])
        # how a token is formed: rank, left and right part (a base symbol: at once, of nothing)
        self.formed = {vocab[c]: (-1, -1, -1) for c in base}
        for token, spelled in symbols.items():
            if len(spelled) > 1 and (how := self._formed(token, spelled)):
                self.formed[token] = how
        for (a, b), (rank, _) in self.rank.items():
            if any(x in self.formed and self.formed[x][0] >= rank for x in (a, b)):
                raise ValueError("merges must rank after those that form their parts")
        letter = {vocab[c]: c for c in letters()} | {vocab[c + end]: c for c in letters()}
        closing = {vocab[c + end] for c in letters()}
        self.inner, self.final = {}, {}
        for token in self.formed:
            spelled = symbols[token]
            at = self.final if spelled[-1] in closing else self.inner
            at["".join(letter[s] for s in spelled)] = token
        self.longest = max(map(len, (*self.inner, *self.final)))
        self.size = max(self.name) + 1

    def _formed(self, token: int, spelled: tuple[int, ...]) -> tuple[int, int, int] | None:
        """The last merge of a token's own spelling, if that gives the token."""
        row = list(spelled)
        while len(row) > 1:
            rank, i = min((self.rank.get(pair, (_NEVER, 0))[0], i) for i, pair in enumerate(zip(row, row[1:])))
            if rank == _NEVER:
                return None
            if len(row) == 2:
                new = self.rank[row[0], row[1]][1]
                return (rank, row[0], row[1]) if new == token else None
            row[i : i + 2] = [self.rank[row[i], row[i + 1]][1]]
        return None


class Words:
    """Encodes distinct words by one walk of their trie."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.stands: dict[int, bool] = {}
        self.grown: dict[int, int] = {}
        self.alone: dict[int, int] = {}
        self.edges: tuple[dict, dict] = ({}, {})

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The pieces that stand at a token's edge while it is formed, each with the rank that takes it up."""
        known = self.edges[right]
        if token not in known:
            out, piece, up = [], token, _NEVER
            while piece >= 0:
                out.append((piece, up))
                up, *parts = self.vocabulary.formed[piece]
                piece = parts[right]
            known[token] = out
        return known[token]

    def _beside(self, left: int, right: int) -> bool:
        rank = self.vocabulary.rank
        for a, up_a in self._edge(left, True):
            for b, up_b in self._edge(right, False):
                r = rank.get((a, b))
                if r is not None and r[0] < up_a and r[0] <= up_b:
                    return False
        return True

    def _stands(self, before: int, spelled: str, final: bool) -> int:
        """The token of this spelling, if there is one that stands beside the state before it, else -1."""
        token = (self.vocabulary.final if final else self.vocabulary.inner).get(spelled, -1)
        if token < 0 or before < 0:
            return token
        key = before * self.vocabulary.size + token
        ok = self.stands.get(key)
        if ok is None:
            ok = self.stands[key] = self._beside(before, token)
        return token if ok else -1

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, in the order of the words, and how many each has.  Words aren't empty."""
        grown, alone, size, longest = self.grown, self.alone, self.vocabulary.size, self.vocabulary.longest
        # of the prefixes on the path, by their length: the token that ends each, and where it starts
        state = [-1] * (max(map(len, words), default=0) + 1)
        start = [0] * len(state)
        ids: list[int] = []
        at = [0] * (len(words) + 1)
        before = ""
        order = sorted(range(len(words)), key=words.__getitem__)
        for place in order:
            word = words[place]
            n = len(word)
            depth, most = 0, min(n, len(before)) - 1
            while depth < most and word[depth] == before[depth]:
                depth += 1
            before = word
            for d in range(depth + 1, n + 1):
                # the last token grows, or the symbol stands alone: both are remembered; else it is any other suffix
                last, k, symbol = state[d - 1], start[d - 1], ord(word[d - 1]) + (d == n) * 512
                key = ((state[k] + 1) * size + last + 1) * 1024 + symbol
                token = grown.get(key)
                if token is None:
                    token = grown[key] = self._stands(state[k], word[k:d], d == n)
                if token < 0:
                    k = d - 1
                    key = last * 1024 + symbol
                    token = alone.get(key)
                    if token is None:
                        token = alone[key] = self._stands(last, word[k:d], d == n)
                    while token < 0:
                        k -= 1
                        if k < 0 or d - k > longest:
                            raise ValueError(f"no token ends {word[:d]!r}")
                        token = self._stands(state[k], word[k:d], d == n)
                state[d], start[d] = token, k
            own = [token]
            while k:
                own.append(state[k])
                k = start[k]
            ids += own[::-1]
            at[place] = len(own)
        # back from the order of the trie to that of the words
        sizes = np.array(at[:-1], np.int64)
        order = np.array(order, np.int64)
        first = np.zeros(len(words), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return gathered(np.array(ids, np.int32), first, sizes), sizes


def _plain(spec: dict) -> str | None:
    """The pattern of the words, if pre-tokenization does nothing but to find them and to spell their bytes."""
    before = spec.get("pre_tokenizer") or {}
    steps = before["pretokenizers"] if before.get("type") == "Sequence" else [before]
    if len(steps) != 2 or [x.get("type") for x in steps] != ["Split", "ByteLevel"]:
        return None
    find, spell = steps
    plain = find["behavior"] == "Removed" and find["invert"] and not spell["add_prefix_space"] and not spell["use_regex"]
    return find["pattern"].get("Regex") if plain else None


class Encoder:
    """Ids of whole texts; ids of runs and words that recur are kept."""

    def __init__(self, spec: str, vocabulary: Vocabulary):
        import regex
        from tokenizers import Tokenizer

        library, d = Tokenizer.from_str(spec), json.loads(spec)
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        # words of printable ASCII characters, and the spaces between runs
        self.ascii = regex.compile(f"{pattern}| ") if (pattern := _plain(d)) else None
        self.vocabulary = vocabulary
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, names))})") if names else re.compile("(?!)")
        self.forget()

    def forget(self) -> None:
        self.encode = Words(self.vocabulary)
        self.runs: dict[bytes, int] = {}
        self.words: dict[str, int] = {}
        self.run_sizes, self.run_ids = array("q"), array("i")
        self.word_sizes, self.word_ids = array("q"), array("i")

    def _normal(self, runs: list[str]) -> list[str]:
        joined = self.normalize(_BETWEEN.join(runs)).split(_BETWEEN)
        return joined if len(joined) == len(runs) else [self.normalize(r) for r in runs]

    def _words(self, parts: list[str]) -> tuple[list[str], np.ndarray]:
        """All words of normalized parts, and the part of each."""
        words: list[str] = []
        owner = []
        simple = [self.ascii is not None and x.isascii() and x.isprintable() and " " not in x for x in parts]
        some = np.flatnonzero(simple)
        if len(some):
            found = self.ascii.findall(" ".join([parts[i] for i in some]))
            words = [w for w in found if w != " "]
            space = np.fromiter((w == " " for w in found), bool, len(found))
            owner.append(some[np.cumsum(space)[~space]])
        rest = np.flatnonzero(~np.array(simple, bool))
        if len(rest):
            others = [parts[i] for i in rest]
            starts = np.cumsum([0, *(len(x) + 1 for x in others)])
            found = self.split(" ".join(others))
            words += [w for w, _ in found]
            place = np.fromiter((span[0] for _, span in found), np.int64, len(found))
            owner.append(rest[np.searchsorted(starts, place, "right") - 1])
        return words, np.concatenate(owner) if owner else np.zeros(0, np.int64)

    def learn(self, new: list[bytes]) -> None:
        """Keeps the ids of new runs."""
        texts = [run.decode() for run in new]
        parts, owner, added = texts, np.arange(len(texts)), np.zeros(0, np.int64)
        special = np.zeros(0, np.int64)
        if self.special.search("\n".join(texts)):  # every other part of a run is an added token
            split = [self.special.split(text) for text in texts]
            parts = [part if not k % 2 else "" for each in split for k, part in enumerate(each)]
            owner = np.repeat(owner, [len(each) for each in split])
            ids = [self.vocabulary.special[part] if k % 2 else -1 for each in split for k, part in enumerate(each)]
            added = np.flatnonzero(np.array(ids) >= 0)
            special = np.array(ids, np.int64)[added]
        words, part = self._words(self._normal(parts))
        fresh = [w for w in dict.fromkeys(words) if w not in self.words]
        ids, sizes = self.encode(fresh)
        self.words.update(zip(fresh, range(len(self.word_sizes), len(self.word_sizes) + len(fresh))))
        self.word_sizes.frombytes(sizes.tobytes())
        self.word_ids.frombytes(ids.tobytes())
        word = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        sizes = np.frombuffer(self.word_sizes, np.int64)
        # words and added tokens in their order
        order = np.argsort(np.r_[part, added], kind="stable")
        first = np.r_[(np.cumsum(sizes) - sizes)[word], -1 - special][order]
        n = np.r_[sizes[word], np.ones(len(added), np.int64)][order]
        flat = gathered(np.frombuffer(self.word_ids, np.int32), first, n)
        self.runs.update(zip(new, range(len(self.run_sizes), len(self.run_sizes) + len(new))))
        run = owner[np.r_[part, added][order]]
        self.run_sizes.frombytes(np.bincount(run, n, len(new)).astype(np.int64).tobytes())
        self.run_ids.frombytes(flat.astype(np.int32).tobytes())

    def __call__(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and where each row starts (one more entry at the end)."""
        starts, ends, row = common.spans(common.word_bytes()[data], at)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
        runs = [common.packed(data, starts[i : i + STEP_RUNS], ends[i : i + STEP_RUNS]) for i in range(0, len(starts), STEP_RUNS)]
        column = pa.chunked_array(runs).dictionary_encode().combine_chunks()
        raw, cuts = common.utf8(column.dictionary)
        raw, cuts = raw.tobytes(), cuts.tolist()
        distinct = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(self.runs) > KEPT_RUNS:
            self.forget()
        known = self.runs
        if new := [r for r in distinct if r not in known]:
            self.learn(new)
        place = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))[column.indices.to_numpy()]
        sizes = np.frombuffer(self.run_sizes, np.int64)
        n = sizes[place]
        ids = gathered(np.frombuffer(self.run_ids, np.int32), (np.cumsum(sizes) - sizes)[place], n)
        return ids, np.r_[0, np.cumsum(n)][np.searchsorted(row, np.arange(len(at)))]


def gathered(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` from ``first``, each ``n`` long, end to end; a negative start stands for a value itself."""
    ends = np.cumsum(n)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, values.dtype)
    alone = first < 0
    take = np.arange(ends[-1]) + np.repeat(np.where(alone, 0, first) - (ends - n), n)
    if not alone.any():
        return values[take]
    own = np.repeat(alone, n)
    out = np.zeros(len(take), values.dtype)
    out[~own] = values[take[~own]]
    out[own] = -1 - np.repeat(first, n)[own]
    return out


# --- over Spark --------------------------------------------------------------------------------------------------


def _sent(df: DataFrame, tokenizer: str):
    """A tokenizer file and the vocabulary made from it, on their way to all tasks."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    return df.sparkSession.sparkContext.broadcast((spec, Vocabulary(spec)))  # as large as the vocabulary


def encoded(df: DataFrame, text: str, tokenizer: str) -> Column:
    """The ids of each whole text.  ``tokenizer``: a file of the tokenizers library, read on the driver."""
    common.small_batches(df.sparkSession)
    sent = _sent(df, tokenizer)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common.one_thread()
        encoder = Encoder(*sent.value)
        for column in batches:
            parts = []
            for a, b in common.slices(column, STEP_BYTES):
                ids, first = encoder(*common.utf8(column.slice(a, b - a)))
                parts.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return run(common.text_of(df, text))


def _names(vocabulary: Vocabulary) -> list[str | None]:
    """The tokens' strings by id."""
    return [vocabulary.name.get(i) for i in range(vocabulary.size)]


def spelled(names: pa.Array, lists: pa.ListArray) -> pa.Array:
    """The text of each list of ids; ids without a name have none."""
    ids = lists.flatten()
    own = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(names)))
    words = names.take(pc.if_else(own, ids, pa.scalar(None, ids.type)))
    words = pa.ListArray.from_arrays(pa.array(common.list_offsets(lists), pa.int32()), words)
    if words.values.null_count:
        return pa.array([" ".join(x for x in each if x is not None) for each in words.to_pylist()], pa.string())
    return pc.binary_join(words, " ")


def decoded(df: DataFrame, ids: str, tokenizer: str) -> Column:
    """The text of each list of ids, added tokens included; ids outside the vocabulary have none."""
    with open(tokenizer, encoding="utf-8") as f:
        sent = df.sparkSession.sparkContext.broadcast(_names(Vocabulary(f.read())))

    @F.arrow_udf(T.StringType())
    def run(column: pa.Array) -> pa.Array:
        return spelled(pa.array(sent.value, pa.string()), column)

    return run(F.coalesce(df[f"`{ids}`"], F.array().cast("array<int>")))


def digests(df: DataFrame, doc_id: str, text: str, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (as little-endian unsigned 32-bit integers) and of the text decoded from them.

    Ids and decoded text stay in the worker that makes them.
    """
    common.small_batches(df.sparkSession)
    sent = _sent(df, tokenizer)
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common.one_thread()
        encoder = Encoder(*sent.value)
        names = pa.array(_names(encoder.vocabulary), pa.string())
        for column in batches:
            n, of_ids, of_texts = [np.zeros(0, np.int64)], [], []
            for a, b in common.slices(column, STEP_BYTES):
                ids, first = encoder(*common.utf8(column.slice(a, b - a)))
                texts, at = common.utf8(spelled(names, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))))
                n.append(np.diff(first))
                for values, cut, out in ((ids.astype("<u4"), first, of_ids), (texts, at, of_texts)):
                    out += [hashlib.sha256(values[i:j]).hexdigest() for i, j in zip(cut, cut[1:])]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(n)), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                [f.split(" ")[0] for f in kind.split(", ")],
            )

    rows = df.select(df[f"`{doc_id}`"].alias("doc_id"), run(common.text_of(df, text)).alias("_own"))
    return rows.select("doc_id", "_own.*")
