import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from gridlark.llm import replytrees
from gridlark.llm.queries import QUERIES

SCHEMA = "tree string, node long, parent long, role string, text string, score double"
ODD = ["\\", "\\b", "\\\\o", "<turn>", "</turn>", "</turn>\n", "<turn>user\nx</turn>\n", "\\### Assistant: </turn> ok", "", "é\U0001f600\n", "\\n"]


def paths(rows):
    """All root-to-leaf paths, by walking up from each leaf."""
    by = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}
    for r in rows:
        if r[1] not in parents:
            path = [r]
            while path[0][2] in by:
                path.insert(0, by[path[0][2]])
            yield path


def tree(n, seed):
    out, x = [], seed
    for i in range(n):
        x = (x * 48271 + 7) % 2147483647
        parent = None if i == 0 or x % 17 == 0 else seed * 1000 + x // 20 % i
        role = None if x % 13 == 0 else ("user", "assistant")[x // 3 % 2]
        out.append((f"t{seed}", seed * 1000 + i, parent, role, ODD[x % len(ODD)] if x % 5 else None, None if x % 11 == 0 else (x % 7) / 4))
    return out


@pytest.fixture(scope="module")
def messages():
    chain = [(None, 9000 + i, 8999 + i if i else None, "assistant", f"m{i}", 1.0) for i in range(70)]
    return tree(40, 1) + tree(25, 2) + [("one", 5, 4711, "user\n<turn>", "alone", 0.0)] + chain


def want(rows, best):
    groups = {}
    for path in paths(rows):
        mean = sum(r[5] or 0.0 for r in path) / len(path)
        groups.setdefault(path[0][1], []).append((-mean, -len(path), path[-1][1], path))
    for found in groups.values():
        for rank, (*_, path) in enumerate(sorted(found, key=lambda x: (round(x[0], 9), *x[1:3]))[:best], 1):
            yield rank, path


@pytest.mark.parametrize("best", [1, 2, None])
def test_branches_against_walks(spark, messages, best):
    df = spark.createDataFrame(messages, SCHEMA).repartition(3)
    out = replytrees.formatted(df, best)
    out = out.select("tree", "leaf", "rank", replytrees.parsed().alias("turns"), replytrees.under_loss().alias("loss"))
    got = {(r.tree, r.leaf): (r.rank, [tuple(t) for t in r.turns], r.loss) for r in out.collect()}
    expected = {
        (p[-1][0], p[-1][1]): (rank, [(r[3] or "", r[4] or "") for r in p], "".join(r[4] or "" for r in p if r[3] == "assistant"))
        for rank, p in want(messages, best)
    }
    assert got == expected


def test_cycles_raise(spark):
    df = spark.createDataFrame([("t", 1, 2, "user", "a", 0.0), ("t", 2, 1, "user", "b", 0.0)], SCHEMA)
    with pytest.raises(ValueError, match="cycle"):
        replytrees.branches(df)


def test_linear_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (None, 1, "user", None), (None, 1, "user", None),
            (1, 2, "assistant", "b"), (2, None, None, "x"), (2, 0, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    out = replytrees.formatted(replytrees.linear(df, "conv_id", "turn", "role", "text"))
    got = {r.tree: [tuple(t) for t in r.turns] for r in out.select("tree", replytrees.parsed().alias("turns")).collect()}
    assert got == {
        1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("user", "")] * 2, 2: [("", "x"), ("assistant", "y")]
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert replytrees.formatted(replytrees.linear(df, "conv_id", "turn", "role", "text")).count() == 0


def test_query_has_the_imitation(spark, sf):
    row = QUERIES["op3_reply_trees"](spark, sf).where("conv_id = -7").first()
    says = r"\### Assistant: </turn> ok"
    assert (row.n_turns, row.loss_chars) == (2, len(says))
    assert row.turns_sha256 == hashlib.sha256(f"user\n{says}\nassistant\n{says}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(says.encode()).hexdigest()


def test_the_mask_marks_the_text_that_is_cut(spark, messages):
    """Spans, taken from the formatted text by their positions, are the trained texts."""
    out = replytrees.formatted(spark.createDataFrame(messages, SCHEMA), None)
    undo = {"\\b": "\\", "\\o": "<turn>", "\\c": "</turn>"}
    for r in out.select("formatted", "loss", replytrees.under_loss().alias("cut")).collect():
        marked = "".join(r.formatted[s.start : s.start + s.length] for s in r.loss)
        assert re.sub(r"\\[boc]", lambda m: undo[m[0]], marked) == r.cut
        assert len(r.loss) == r.formatted.count("</turn>\n")


def test_a_long_conversation_takes_linear_time(spark):
    """Three times 20 000 turns within a minute (a copy of the list for each turn took minutes)."""
    rows = spark.range(60_000).selectExpr(
        "id % 3 AS c", "id DIV 3 AS turn", "if(id DIV 3 % 2 = 0, 'user', 'assistant') AS role", "repeat(char(97 + id % 26), 100) AS text"
    )
    messages = replytrees.linear(rows, "c", "turn", "role", "text").cache()
    # a chain needs no search for its branches
    ends = messages.select("tree", F.col("node").alias("leaf"), F.lit(1).alias("rank"), F.col("node").alias("place"), "node")
    found, replytrees.branches = replytrees.branches, lambda m, best: ends.withColumn("leaf", F.lit(0))
    try:
        began = time.monotonic()
        out = replytrees.formatted(messages).select("tree", F.size("loss").alias("n"), F.char_length(replytrees.under_loss()).alias("chars"))
        assert sorted(map(tuple, out.collect())) == [(c, 20_000, 1_000_000) for c in range(3)]
        assert time.monotonic() - began < 60
    finally:
        replytrees.branches = found
