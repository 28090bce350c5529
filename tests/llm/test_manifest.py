import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridlark.llm import manifest, queries


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    """(left, right) siblings of a leaf at each level."""
    out = []
    for level in tree[:-1]:
        run = i // 3 * 3
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return out


def brute(rows, now):
    """Of rows (doc_id, source, lang, n_chars, text): what ``proved`` returns, with ``now`` giving each row's present text."""

    def leaf(fields):
        return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), leaf((*row[:4], now(row)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (has, id_, own, other) in enumerate(sorted(groups[s])):
            beside = path(trees[s], i) + path(top, k)
            h = other
            for left, right in beside:
                h = H(left, h, right)
            proof = H(*(x for pair in beside for x in pair))
            root = top[-1][0]
            out.append((id_ if has else None, own, trees[s][-1][0], root, proof, h, h == root))
    return Counter(out)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string, word int, n double"


def proved(df):
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest.proved(df, "doc_id", "source", COLUMNS, {"text": text}).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def without_feeds(row):
    hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
    return row[4].replace("\n", "") if hit and row[4] is not None else row[4]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "t", "l", 1, 2.0) for r in rows], SCHEMA).repartition(3)
    assert Counter(map(tuple, proved(df).collect())) == brute(rows, without_feeds)


def test_sizes_of_trees(spark):
    """Lone leaves, whole and ragged runs, one array of slots and several, ids of both signs and far apart."""
    rows = []
    for k, n in enumerate((1, 2, 3, 4, 9, 10, 27, 28, 243, 244, 800)):
        rows += [(k * 10_000 + i * (1 + k) - 20_000, f"s{k}", "en", i, f"text\n{i}") for i in range(n)]
    rows += [(i * 7_919_000_000_000 - (1 << 62), None, None, None, f"a\nb{i}") for i in range(40)]
    rows += [((1 << 63) - 1, "ends", "x", 1, "y\n"), (-(1 << 63), "ends", "x", 1, "z\n"), (0, "ends", "", 0, "")]
    check(spark, rows)


def test_deep_directory(spark, monkeypatch):
    """So few children a prefix that counts stand over several levels."""
    monkeypatch.setattr(manifest, "CHILDREN_BITS", 3)
    rows = [(x * x * 37 % 1_000_003 - 400_000, f"s{x % 3}", "en", x, "q") for x in range(900)]
    rows = list({r[0]: r for r in rows}.values())
    check(spark, rows)


def test_ids_that_are_null_or_repeat(spark):
    rows = [(i % 50, f"s{i % 2}", "en", 3, f"text {i % 7}\n") for i in range(300)]
    rows += [(None, f"s{i % 2}", None, None, f"no id {i % 4}") for i in range(60)] + [(None, None, None, None, None)] * 5
    rows += [(1000 + i, "s1", "en", 3, "ß\n\n") for i in range(100)]
    check(spark, rows)


def test_arrays_of_few_slots(spark, monkeypatch):
    """Several rounds, also over the groups."""
    monkeypatch.setattr(manifest, "LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 3)
    check(spark, [(i, f"s{i % 11}" if i % 13 else None, "en", i, "a\nb") for i in range(150)])


def test_documents(docs, rows):
    own = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    assert Counter(map(tuple, proved(docs).collect())) == brute(own, without_feeds)


def test_bitmap_words(spark):
    ids = [0, 5, 63, 64, 200, -1, -64, 1 << 40]
    rows = spark.createDataFrame([("=a", i) for i in ids] + [("=a", None)] * 3, "tree string, id long")
    got = {(r.has, r.word): (r.bits % (1 << 64), r.n) for r in manifest.words(rows).collect()}
    want = {(0, 0): (0, 3)}
    for i in ids:
        bits, n = want.get((1, i >> 6), (0, 0))
        want[1, i >> 6] = bits | 1 << (i & 63), n + 1
    assert got == want


@pytest.mark.parametrize("change", ["text", "n_chars", "source"])
def test_any_change_is_noticed(spark, change):
    df = spark.createDataFrame([(i, "s", "en", 5, "hello", "", "", 0, 0.0) for i in range(20)], SCHEMA)
    now = {change: F.when(F.col("doc_id") == 7, F.lit(None)).otherwise(F.col(change))}
    got = manifest.proved(df, "doc_id", "source", COLUMNS, now).collect()
    assert [r.doc_id for r in got if not r.verified] == [7]


def test_empty_table(no_docs):
    assert proved(no_docs).count() == 0


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS).collect()
    got = queries.QUERIES["op13_merkle_bitmaps"](spark, sf)
    assert Counter(map(tuple, got.collect())) == brute([tuple(r) for r in docs], without_feeds)
