"""Chat formatting: conversations from reply trees.

Messages point to the message they answer.  Self-joins find, for jumps of 1, 2, 4, .. steps, the ancestor of each
message, so trees of depth d take about log2(d) joins; the same jumps, from the longest down, enumerate each chosen
branch from its leaf to its root, each message once.  Branches are ranked within their tree by the mean score of their
messages (then the longer, then the lower leaf) and the best ones are formatted.

    <turn>ROLE
    TEXT</turn>

Escapes keep texts and roles from looking like the template: ``\\`` becomes ``\\b``, ``<turn>`` ``\\o``, ``</turn>``
``\\c``, and in roles a line feed ``\\n``.  ``\\`` occurs in escaped text only as the start of these, so they are undone
one after the other.  The loss mask is a list of (start, length), in code points of the formatted text, one for each
turn in order, with length 0 for turns that aren't trained on.

A null text counts as empty, a null role as an empty role; a null score as 0.  A message without a parent in the table
is a root.  Null tree ids are one tree.  Repeated rows of one turn follow each other (``linear``), ordered by role and a
hash of the text.  Cycles of parents raise an error.  An empty table gives an empty result.  Columns that aren't named
are not read.  A conversation is one row of the output, so its turns meet in one task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from . import common

OPEN, CLOSE = "<turn>", "</turn>\n"
TRAINED = "assistant"


def linear(df: DataFrame, tree: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows of ordered turns as messages whose parent is the turn before: tree, node, parent, role, text, score (0)."""
    rows = df.select(
        df[f"`{tree}`"].alias("tree"), df[f"`{turn}`"].alias("_turn"),
        common.text_of(df, role).alias("role"), common.text_of(df, text).alias("text"),
    )
    keys = ["tree", "_turn", "role", F.xxhash64("text")]
    nodes = stored(common.numbered(stored(common.in_order(rows, keys)), number="node").drop("_at"))
    before = nodes.select((F.col("node") + 1).alias("node"), F.col("tree").alias("_tree"), F.lit(True).alias("_any"))
    same = F.col("_any") & F.col("_tree").eqNullSafe(F.col("tree"))
    parent = F.when(same, F.col("node") - 1).alias("parent")
    return nodes.join(before, "node", "left").select("tree", "node", parent, "role", "text", F.lit(0.0).alias("score"))


def _jumps(links: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ..: (node, up, total) with the ancestor 2 to the k steps up and the scores on the way, while any has one."""
    out = [stored(links)]
    most = out[0].count().bit_length() + 1  # no path has more steps than there are links
    while not out[-1].isEmpty():
        if len(out) > most:
            raise ValueError("the parents of some messages form a cycle")
        last = out[-1]
        then = last.select(F.col("node").alias("up"), F.col("up").alias("_further"), F.col("total").alias("_more"))
        joined = last.join(then, "up").select("node", F.col("_further").alias("up"), F.col("total") + F.col("_more"))
        out.append(stored(joined.toDF("node", "up", "total")))
    return out[:-1]


def branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, place, node) for each message of the ``best`` branches of each tree (None: all); place 0 is the root."""
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    ids = nodes.select(F.col("node").alias("parent"))
    links = nodes.where("parent IS NOT NULL").join(ids, "parent", "left_semi")
    jumps = _jumps(links.select("node", F.col("parent").alias("up"), F.col("score").alias("total")))
    leaves = nodes.join(links.select(F.col("parent").alias("node")), "node", "left_anti")
    # from each leaf up to its root by the longest jumps that fit: depth and the sum of scores
    way = leaves.select("tree", F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0).cast("bigint").alias("depth"), F.lit(0.0).alias("total"))
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("node").alias("at"), "up", F.col("total").alias("_more"))
        went = F.col("up").isNotNull()
        way = way.join(jump, "at", "left").select(
            "tree", "leaf", F.coalesce("up", "at").alias("at"),
            F.when(went, F.col("depth") + (1 << k)).otherwise(F.col("depth")).alias("depth"),
            F.when(went, F.col("total") + F.col("_more")).otherwise(F.col("total")).alias("total"),
        )
    top = nodes.select(F.col("node").alias("at"), F.col("score").alias("_own"))
    ranked = way.join(top, "at").withColumn("mean", (F.col("total") + F.col("_own")) / (F.col("depth") + 1))
    # grouped by root: a tree id may be shared by several roots
    order = Window.partitionBy("at").orderBy(F.desc("mean"), F.desc("depth"), "leaf")
    if best == 1:
        first = F.min_by("leaf", F.struct(-F.col("mean"), -F.col("depth"), F.col("leaf")))
        picked = ranked.groupBy("at").agg(first.alias("leaf")).join(ranked, ["at", "leaf"]).withColumn("rank", F.lit(1))
    else:
        picked = ranked.withColumn("rank", F.row_number().over(order))
        picked = picked if best is None else picked.where(F.col("rank") <= best)
    paths = stored(picked.select("tree", "leaf", "rank", F.col("depth").alias("place"), F.col("leaf").alias("node")))
    # what lies 2 to the k above messages already found, for falling k, is every message once
    for k in reversed(range(len(jumps))):
        joined = paths.join(jumps[k].select("node", "up"), "node", "left")
        own, above = F.struct("place", "node"), F.struct((F.col("place") - (1 << k)).alias("place"), F.col("up").alias("node"))
        both = F.when(F.col("up").isNull(), F.array(own)).otherwise(F.array(own, above))
        paths = joined.select("tree", "leaf", "rank", F.explode(both).alias("_at")).select("tree", "leaf", "rank", "_at.*")
    return paths


def escaped(text: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<turn>", "\\o"), ("</turn>", "\\c")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for raw, code in (("\n", "\\n"), ("</turn>", "\\c"), ("<turn>", "\\o"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def formatted(messages: DataFrame, best: int | None = 1, trained: str = TRAINED) -> DataFrame:
    """One row per chosen branch: tree, leaf, rank, formatted, loss (list of start and length, one for each turn)."""
    paths = branches(messages, best)
    turns = paths.join(messages.select("node", "role", "text"), "node")
    head = F.concat(F.lit(OPEN), F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escaped(F.coalesce("text", F.lit("")))
    own = F.when(F.col("role") == trained, F.char_length(body)).otherwise(0)
    turns = turns.select("tree", "leaf", "rank", "place", F.concat(head, body, F.lit(CLOSE)).alias("piece"), F.char_length(head).alias("_head"), own.alias("_own"))
    # where a turn starts is the length of all before it: a running sum, so a long conversation takes linear time
    branch = ["tree", "leaf", "rank"]
    size = F.char_length("piece").cast("bigint")
    to_here = Window.partitionBy(*branch).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(size).over(to_here) - size + F.col("_head")
    span = F.struct(start.alias("start"), F.col("_own").cast("bigint").alias("length")).alias("span")
    turns = turns.select(*branch, "place", "piece", span)
    whole = turns.groupBy(*branch).agg(F.sort_array(F.collect_list(F.struct("place", "piece", "span"))).alias("_turns"))
    return whole.select(*branch, F.array_join("_turns.piece", "").alias("formatted"), F.col("_turns.span").alias("loss"))


def _pieces(formatted: str) -> str:
    """SQL of the turns of a formatted conversation, each up to the end of its text."""
    pieces = f"split(`{formatted}`, '{CLOSE[:-1]}\\n')"
    return f"slice({pieces}, 1, size({pieces}) - 1)"


def parsed(formatted: str = "formatted") -> Column:
    """The turns (role, text) of a formatted conversation."""
    role = f"substring_index(substring(p, {len(OPEN) + 1}), '\\n', 1)"
    text = f"substring(p, {len(OPEN) + 2} + char_length({role}))"
    raw = F.expr(f"transform({_pieces(formatted)}, p -> named_struct('role', {role}, 'text', {text}))")
    return F.transform(raw, lambda t: F.struct(unescaped(t.role).alias("role"), unescaped(t.text).alias("text")))


def under_loss(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, in order, unescaped.

    The mask has a span for each turn, which ends where the turn's text does; so each is cut from its own turn, and none
    is looked for from the start of the conversation.
    """
    cut = f"zip_with({_pieces(formatted)}, `{loss}`, (p, s) -> right(p, CAST(s.length AS INT)))"
    return unescaped(F.array_join(F.expr(cut), ""))
