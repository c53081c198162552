"""A trie of conversations, built by van Emde Boas recursion over their depth.

With 2**levels the least power of two above the longest conversation:

1. *Blocks*, from single turns up: the name of 2**j turns in a row is the digest of its halves' names.
2. *Cuts*, from whole conversations down: a problem is a root and the different blocks below it. Each
   is cut at half its depth; a different left half makes a cut node, which is named by the root and that
   half. The left halves are the upper trie, under the old root; the right halves are lower forests,
   each under its cut node. All problems of a level are cut at once, and equal left halves go on as one
   row with a weight, until each problem is one turn deep: its rows are the nodes.
3. *Totals*, grafted upward: the total of a forest of depth 2**j is that of its upper trie and those of
   the lower forests that hang on its cut nodes. From these, the total below a node at an odd multiple
   of 2**j is its forest's of that depth and what hangs below the forest's last nodes, which lie at
   multiples of 2**(j+1) and are done before.

Rows halve from level to level, so all levels together work on a few times the turns, in a number
of rounds that follows the logarithm of the depth. No step holds a conversation, a node's members or
its children in one task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from .common import WORD, full_text, hot_keys, skewed_join, written
from .joined import joined_digests

#: Bytes of a name, of SHA-256.
NAME_BYTES = 16
#: A conversation grows from the first turns of the one at the multiple of EVERY before it; of fewer than MOST.
EVERY = 20
MOST = 4
#: Characters of a text that order turns of equal number and role; what is equal in these, its digest orders.
ORDER_CHARS = 64

_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _named(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, NAME_BYTES)


def _root() -> Column:
    return F.lit(bytes(NAME_BYTES))


def turns_of(
    conversations: DataFrame,
    id_column: str = "conv_id",
    order_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv, n, name, words) of each turn, written: its number from 1, the digest of role and text.

    Turns are in the order of ``order_column``, null first; turns of one number in that of role and
    text. Null roles and texts are empty. Rows of a null id belong to no conversation.
    """
    role, text = full_text(role_column), full_text(text_column)
    own = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("conv"),
        F.col(order_column).alias("turn"),
        role.alias("role"),
        F.substring(text, 1, ORDER_CHARS).alias("head"),
        _named(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    placed = number_rows(own, ["conv"], ["turn", "role", "head", "name"], "n")
    return written(placed.select("conv", "n", "name", "words"), "trie-turns")


def regrown(turns: DataFrame, every: int = EVERY, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """((conv, place, name, words), (conv, length)): conversations that begin with another one's turns.

    Conversation c is the first h turns of conversation c - c % every, where h is the CRC-32 of c in
    decimals modulo ``most``, and its own turns after its first h. It may have no turns. ``%`` has the
    sign of c.
    """
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    counts = written(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")), "trie-counts")
    bases = counts.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    grown = written(
        counts.withColumn("base", F.col("conv") - F.col("conv") % every)
        .join(bases, "base", "left")
        .select(
            "conv", "base", "turns",
            shared.alias("shared"),
            F.least(shared, F.coalesce("base_turns", F.lit(0))).alias("taken"),
        )
        .withColumn("length", F.col("taken") + F.greatest(F.col("turns") - F.col("shared"), F.lit(0))),
        "trie-grown",
    )
    heads = turns.where(f"conv % {every} = 0 and n < {most}").withColumnRenamed("conv", "base")
    front = (
        grown.where("taken > 0")
        .join(heads, "base")
        .where("n <= taken")
        .select("conv", (F.col("n") - 1).alias("place"), "name", "words")
    )
    hot = hot_keys(counts, ["conv"], "turns", max(1, turns.count()))
    moved = skewed_join(turns, grown.select("conv", "taken", "shared"), ["conv"], hot)
    rest = moved.where("n > shared").select(
        "conv", (F.col("n") - 1 - F.col("shared") + F.col("taken")).alias("place"), "name", "words"
    )
    return written(front.unionByName(rest), "trie-steps"), grown.select("conv", "length")


def _blocks(steps: DataFrame, levels: int) -> list[DataFrame]:
    """Blocks (conv, q, name, words, size, left, right) of 2**j turns for j from 1 to ``levels``.

    The last block of a conversation may be shorter; then ``right`` may be null.
    """
    below = steps.select("conv", F.col("place").alias("q"), "name", "words", F.lit(1).cast("long").alias("size"))
    out = []
    for _ in range(levels):
        half = F.struct("name", "words", "size")
        even = F.col("q") % 2 == 0
        pairs = below.groupBy("conv", F.shiftright("q", 1).alias("q")).agg(
            F.max(F.when(even, half)).alias("left"), F.max(F.when(~even, half)).alias("right")
        )
        none = F.lit(0).cast("long")
        below = written(
            pairs.select(
                "conv", "q",
                _named(F.col("left.name"), F.coalesce("right.name", F.lit(b""))).alias("name"),
                (F.col("left.words") + F.coalesce("right.words", none)).alias("words"),
                (F.col("left.size") + F.coalesce("right.size", none)).alias("size"),
                "left", "right",
            ),
            "trie-blocks",
        )
        out.append(below)
    return out


def _cut(blocks: list[DataFrame]) -> list[DataFrame]:
    """Problems of depth 2**j for j from 0: (root, q, rep, weight, bottom, ends, words), a row per different block.

    ``rep`` is the least conversation that has the block under this root, ``weight`` their number,
    ``bottom`` the node at the end of a block of full depth, ``ends`` the name of the whole
    conversations that end within the block if it is their last.
    """
    none = F.lit(None).cast("binary")
    problem = blocks[-1].groupBy("name").agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("weight"), F.max("words").alias("words")
    )
    problem = written(
        problem.select(
            _root().alias("root"), F.lit(0).cast("long").alias("q"), "rep", "weight",
            none.alias("bottom"), F.col("name").alias("ends"), "words",
        ),
        "trie-problems",
    )
    out = [problem]
    for j in range(len(blocks), 0, -1):
        halves = blocks[j - 1].select(F.col("conv").alias("rep"), "q", "left", "right")
        cut = problem.drop("words").join(halves, ["rep", "q"])
        cut = cut.withColumn("node", F.when(F.col("left.size") == 1 << (j - 1), _named("root", "left.name")))
        upper = (
            cut.groupBy("root", "q", F.col("left.name").alias("name"))
            .agg(
                F.min("rep").alias("rep"), F.sum("weight").alias("weight"), F.max("node").alias("bottom"),
                F.max(F.when(F.col("right").isNull(), F.col("ends"))).alias("ends"), F.max("left.words").alias("words"),
            )
            .select("root", (F.col("q") * 2).alias("q"), "rep", "weight", "bottom", "ends", "words")
        )
        lower = cut.where("right is not null").select(
            F.col("node").alias("root"), (F.col("q") * 2 + 1).alias("q"), "rep", "weight", "bottom", "ends",
            F.col("right.words").alias("words"),
        )
        problem = written(upper.unionByName(lower), "trie-problems")
        out.append(problem)
    return out[::-1]


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("at", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _hung(problems: DataFrame, level: int, odd: int, totals: DataFrame) -> DataFrame:
    """``totals`` of the nodes at the bottom of blocks, handed to these blocks' roots."""
    below = totals.select(F.col("at").alias("bottom"), "leaves", "saved")
    up = problems.where(F.col("bottom").isNotNull() & (F.col("q") % 2 == odd)).select("root", "q", "bottom")
    return up.join(below, "bottom").select(
        F.col("root").alias("at"), F.shiftleft("q", level).alias("depth"), "leaves", "saved"
    )


def _below(problems: list[DataFrame], values: DataFrame) -> DataFrame:
    """(at, depth, leaves, saved): the totals of all nodes strictly below each node that has any."""
    levels = len(problems) - 1
    forests = [written(_sums(values.select(F.col("parent").alias("at"), (F.col("depth") - 1).alias("depth"), "leaves", "saved")), "trie-forests")]
    for j in range(1, levels + 1):
        own = forests[-1].where(F.col("depth") % (1 << j) == 0)
        hung = _hung(problems[j - 1], j - 1, 0, forests[-1])
        forests.append(written(_sums(own.unionByName(hung)), "trie-forests"))
    done = forests[-1].where("depth = 0")
    for j in range(levels - 1, -1, -1):
        own = forests[j].where(F.col("depth") % (2 << j) == 1 << j)
        hung = _hung(problems[j], j, 1, done)
        done = done.unionByName(written(_sums(own.unionByName(hung)), "trie-totals"))
    return done


def prefix_trie(steps: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations.

    ``steps`` has each turn of each conversation: conv, place (from 0, without gaps), name (binary,
    equal where turns are), words. ``lengths`` has each conversation, those without turns too: conv
    (once, not null), length.

    A node is a different sequence of first turns, the root the empty one; its members are the
    conversations that begin with it. Columns: conv_id (least member), depth, parent_conv_id (null for
    the root), n_convs (members), n_children, n_leaves (childless nodes in its subtree, itself
    included), saved_tokens (over its subtree: members but one, times words of the node's last turn)
    and ends_sha256 (of the ids of members that end here, in numeric order, joined by commas). A node's
    last turn is that of its conv_id at its depth. No conversations give no rows.
    """
    spark = steps.sparkSession
    lengths = written(lengths, "trie-lengths")
    members, least, deepest = lengths.agg(F.count(F.lit(1)), F.min("conv"), F.max("length")).first()
    empty_digest = hashlib.sha256(b"").hexdigest()
    if not members:
        kinds = ", ".join(f"{c} {'STRING' if c == 'ends_sha256' else 'LONG'}" for c in _COLUMNS)
        return spark.createDataFrame([], kinds)
    wholes = lengths.where("length = 0").select(_root().alias("whole"), "conv")
    top = lengths.select(
        _root().alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(least).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"), F.lit(members).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("words"), _root().alias("ends"),
    ).limit(1)
    nodes, problems = top, []
    if deepest:
        levels = int(deepest).bit_length()
        blocks = _blocks(steps, levels)
        problems = _cut(blocks)
        wholes = wholes.unionByName(blocks[-1].select(F.col("name").alias("whole"), "conv"))
        nodes = nodes.unionByName(
            problems[0].select(
                F.col("bottom").alias("node"), F.col("root").alias("parent"), F.col("rep").alias("conv_id"),
                (F.col("q") + 1).alias("depth"), F.col("weight").alias("n_convs"), "words", "ends",
            )
        )
    kids = written(nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    none = F.lit(0).cast("long")
    nodes = written(
        nodes.join(kids.withColumnRenamed("parent", "node"), "node", "left").select(
            *nodes.columns,
            F.coalesce("n_children", none).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "trie-nodes",
    )
    if problems:
        below = _below(problems, nodes.where("parent is not null"))
    else:
        below = nodes.select(F.col("node").alias("at"), "leaves", "saved").limit(0)
    below = below.select(F.col("at").alias("node"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    # A node that very many others have as their parent: its id is broadcast to them.
    hot = hot_keys(kids, ["parent"], "n_children", max(1, nodes.count()))
    ids = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    child = skewed_join(nodes.where("parent is not null"), ids, ["parent"], hot)
    first = nodes.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        child.select(*first.columns)
        .unionByName(first)
        .join(below, "node", "left")
        .join(joined_digests(wholes.withColumnRenamed("conv", "member")).withColumnRenamed("whole", "ends"), "ends", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("leaves") + F.coalesce("more_leaves", none)).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", none)).alias("saved_tokens"),
            F.coalesce("sha", F.lit(empty_digest)).alias("ends_sha256"),
        )
    )
