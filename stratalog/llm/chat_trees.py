"""Chat formatting of reply trees.

Nodes point to the message they reply to. Self-joins enumerate the paths: each round joins the table
of ancestors with itself, so after ``k`` rounds a node knows its ancestor ``2**k`` steps up, the
number of steps and the scores on the way. Leaves are ranked per tree by the mean score of their
path; only the chosen paths are then spelled out, again by joins with the rounds' tables, and each
becomes one formatted conversation.

Everything is DataFrame operations; the join keys ``(tree, node)`` are unique on one side, so a hot
tree spreads over all tasks until its chosen path is formatted. That one row holds the whole
conversation, because it is the output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.llm.common import kept, text_or_empty


@dataclass(frozen=True)
class TreeTemplate:
    """Marks of a turn; texts and roles are escaped so that no mark can occur inside them.

    ``escapes`` maps characters to their escaped form. The first entry is the escape character
    itself; every mark must hold one of the characters that are escaped.
    """

    open: str = "<|turn|>"
    close: str = "<|end|>"
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
    line_code: str = "\\3"
    learned_role: str = "assistant"


def escaped(text: Column, template: TreeTemplate = TreeTemplate()) -> Column:
    for plain, code in template.escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, template: TreeTemplate = TreeTemplate()) -> Column:
    """Inverse of :func:`escaped`: the escape character itself is put back last."""
    for plain, code in reversed(template.escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def escaped_role(role: Column, template: TreeTemplate = TreeTemplate()) -> Column:
    """A role ends at the end of its line, so line breaks in it are escaped too."""
    return F.replace(escaped(role, template), F.lit("\n"), F.lit(template.line_code))


def unescaped_role(role: Column, template: TreeTemplate = TreeTemplate()) -> Column:
    return unescaped(F.replace(role, F.lit(template.line_code), F.lit("\n")), template)


def linked(nodes: DataFrame) -> DataFrame:
    """Nodes with a text key of their tree (null is a tree of its own), and no dangling parents.

    ``nodes`` has ``tree, node, parent, score``; ``node`` is unique in its tree. A parent that is
    missing makes a root.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("-"))
    own = nodes.select(key.alias("key"), "tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = own.select(F.col("key").alias("_k"), F.col("node").alias("_n"))
    return (
        own.join(known, (F.col("key") == F.col("_k")) & (F.col("parent") == F.col("_n")), "left")
        .select("key", "tree", "node", F.col("_n").alias("parent"), "score")
    )


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Tables ``(key, node, up, steps, total)``, one per round: ``up`` is ``2**k`` steps away.

    ``up`` is null where the path to the root is shorter; ``steps`` and ``total`` then cover the
    whole path. Nodes on or below a cycle never reach a root, so rounds stop at the logarithm of the
    number of nodes.
    """
    table = nodes.select(
        "key", "node", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("steps"), F.col("score").alias("total")
    )
    rounds = [kept(table, "tree-ancestors")]
    limit = rounds[0].count().bit_length() + 1
    while len(rounds) < limit and not rounds[-1].where("up is not null").isEmpty():
        low = rounds[-1].alias("a")
        high = rounds[-1].alias("b")
        met = low.where("up is not null").join(
            high, (F.col("a.key") == F.col("b.key")) & (F.col("a.up") == F.col("b.node"))
        ).select(
            "a.key", "a.node", "b.up",
            (F.col("a.steps") + F.col("b.steps")).alias("steps"),
            (F.col("a.total") + F.col("b.total")).alias("total"),
        )
        ended = rounds[-1].where("up is null")
        rounds.append(kept(met.unionByName(ended), "tree-ancestors"))
    return rounds


def chosen_paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """``(tree, leaf, rank, node, at)`` for the best root-to-leaf paths of each tree.

    ``at`` counts from the root, 0 first. Branches rank by mean score, then length, then leaf id.
    Nodes that no root reaches (cycles) are on no path.
    """
    own = kept(linked(nodes), "tree-nodes")
    rounds = ancestors(own)
    parents = own.where("parent is not null").select(F.col("key").alias("_k"), F.col("parent").alias("_p")).distinct()
    paths = rounds[-1].where("up is null")
    leaves = paths.join(parents, (F.col("key") == F.col("_k")) & (F.col("node") == F.col("_p")), "left_anti")
    order = [(F.col("total") / F.col("steps")).desc(), F.col("steps").desc(), F.col("node")]
    salted = W.partitionBy("key", F.pmod(F.xxhash64("node"), F.lit(64))).orderBy(*order)
    best = leaves.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= per_tree)
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy(*order)))
    best = best.where(F.col("rank") <= per_tree)
    members = best.select("key", F.col("node").alias("leaf"), "rank", (F.col("steps") - 1).alias("at"), "node")
    for k, table in enumerate(rounds[:-1]):
        step = table.where("up is not null").select(F.col("key").alias("_k"), F.col("node").alias("_n"), "up")
        higher = members.join(step, (F.col("key") == F.col("_k")) & (F.col("node") == F.col("_n"))).select(
            "key", "leaf", "rank", (F.col("at") - 2**k).alias("at"), F.col("up").alias("node")
        )
        members = members.unionByName(higher)
        if k % 4 == 3:
            members = kept(members, "tree-members")
    return members.join(own.select("key", "tree", "node"), ["key", "node"]).select(
        "key", "tree", "leaf", "rank", "node", "at"
    )


def formatted(
    nodes: DataFrame, per_tree: int = 1, template: TreeTemplate = TreeTemplate()
) -> DataFrame:
    """One conversation per chosen path: ``tree, leaf, rank, formatted, segments``.

    ``nodes`` has ``tree, node, parent, role, text, score``; null roles and texts count as empty.
    ``segments`` cuts ``formatted`` into pieces of ``(text, loss)``: the pieces under the loss mask
    are the texts of the learned role, with nothing around them. An empty table gives no rows; other
    columns are ignored.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("-"))
    said = nodes.select(
        key.alias("key"), "node",
        text_or_empty(F.col("role")).alias("role"),
        escaped(text_or_empty(F.col("text")), template).alias("text"),
    )
    paths = chosen_paths(nodes.select("tree", "node", "parent", "score"), per_tree)
    head = F.concat(F.lit(template.open), escaped_role(F.col("role"), template), F.lit("\n"))
    turn = F.struct("at", head.alias("head"), "text", (F.col("role") == template.learned_role).alias("loss"))
    off = F.lit(False).alias("loss")
    pieces = F.transform(
        F.sort_array(F.collect_list(turn)),
        lambda t: F.array(
            F.struct(t["head"].alias("text"), off),
            F.struct(t["text"].alias("text"), t["loss"].alias("loss")),
            F.struct(F.lit(template.close + "\n").alias("text"), off),
        ),
    )
    grouped = paths.join(said, ["key", "node"]).groupBy("key", "leaf", "rank").agg(
        F.first("tree").alias("tree"), F.flatten(pieces).alias("segments")
    )
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return grouped.select("tree", "leaf", "rank", whole.alias("formatted"), "segments")


def read_turns(text: Column, template: TreeTemplate = TreeTemplate()) -> Column:
    """Turns as ``(role, text)`` read back from a formatted conversation."""

    def quoted(mark: str) -> str:
        return "\\Q" + mark + "\\E"

    pieces = F.split(text, quoted(template.open))
    said = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    tail = len(template.close) + 1

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        start = F.length(role) + 2
        body = F.substr(piece, start, F.length(piece) - start + 1 - F.lit(tail))
        return F.struct(
            unescaped_role(role, template).alias("role"), unescaped(body, template).alias("text")
        )

    return F.transform(said, turn)


def chain(turns: DataFrame, tree: str = "conv_id", order: str = "turn") -> DataFrame:
    """Turn rows as a tree: each row replies to the row before it. Equal turns go by role and text."""
    rows = W.partitionBy(tree).orderBy(F.col(order).asc_nulls_last(), "role", "text")
    return turns.select(
        F.col(tree).alias("tree"), F.row_number().over(rows).cast("bigint").alias("node"), "role", "text"
    ).withColumns({"parent": F.when(F.col("node") > 1, F.col("node") - 1), "score": F.lit(0.0)})
