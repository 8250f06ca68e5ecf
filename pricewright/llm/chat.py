"""Reply trees to conversations: root-to-leaf paths by iterative self-joins, formatted with a loss mask.

Pointers are doubled: after k self-joins every message knows its 2^k-th ancestor, the
number of messages above it and the sum of their scores, so a chain of n replies
takes log2(n) joins. Leaves are ranked within their tree by the mean score of
their path; the chosen paths are unrolled through the same pointers, from the
longest jump to the shortest, which meets each ancestor exactly once.

A turn is written ``### role: text </turn>`` and a line break. Inside role and text
a backslash precedes ``\\``, ``#`` and, in a role, ``:``; ``</`` becomes ``<\\/``. So neither
``###`` nor ``</turn>`` can stand in a message, and dropping each backslash that is not
itself dropped gives the message back. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.staging import staged

END = " </turn>\n"
_NULL = "\x00"


def escaped(text: Column, more: str = "") -> Column:
    """Control strings broken up by backslashes, reversibly."""
    marked = F.regexp_replace(text, r"([\\#" + more + "])", r"\\$1")
    return F.replace(marked, F.lit("</"), F.lit("<\\/"))


def unescaped(text: Column) -> Column:
    """Drops each backslash and keeps what follows it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _nodes(messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str) -> DataFrame:
    """One row per message, with text keys; null trees are one tree, a null text or role is empty."""
    key = lambda c: F.col(f"`{c}`").cast("string")
    rows = messages.where(F.col(f"`{node}`").isNotNull()).select(
        F.coalesce(key(tree), F.lit(_NULL)).alias("tree"), key(node).alias("node"), key(parent).alias("parent"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{score}`").cast("double"), F.lit(0.0)).alias("score"))
    return rows.groupBy("tree", "node").agg(
        F.min(F.struct(F.coalesce("parent", F.lit(_NULL)).alias("parent"), "role", "text", "score")).alias("m")).select(
        "tree", "node", F.nullif(F.col("m.parent"), F.lit(_NULL)).alias("parent"), "m.role", "m.text", "m.score")


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``tree, node, depth, total`` of all messages below a root, and the pointer tables by jump length."""
    known = nodes.select("tree", F.col("node").alias("up"))
    step = staged(nodes.select("tree", "node", F.col("parent").alias("up"), "score").join(
        known.withColumn("real", F.lit(True)), ["tree", "up"], "left").select(
        "tree", "node", F.when(F.col("real"), F.col("up")).alias("up"), F.lit(1).cast("long").alias("depth"),
        F.col("score").alias("total")), "jump")
    # a message leaves the rounds when it has found its root, so short trees cost few of them
    placed, levels = step.where("up IS NULL"), []
    step = step.where("up IS NOT NULL")
    for _ in range(max(1, step.count()).bit_length() + 1):
        if step.isEmpty():
            break
        levels.append(step.select("tree", "node", "up"))
        above = placed.union(step).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"),
            F.col("total").alias("rest"))
        moved = staged(step.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("rest")).alias("total")), "jump")
        placed = placed.union(moved.where("up IS NULL"))
        step = moved.where("up IS NOT NULL")
    return placed.drop("up"), levels


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, rank, node, depth``: the messages of the best ``branches`` root-to-leaf paths of each tree."""
    placed, levels = _jumps(nodes)
    placed = staged(placed, "placed")
    leaves = placed.join(nodes.select("tree", F.col("parent").alias("node")).distinct(), ["tree", "node"], "left_anti")
    best = leaves.withColumn("rank", F.row_number().over(
        Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), "node"))).where(
        F.col("rank") <= branches)
    found = staged(best.select("tree", F.col("node").alias("leaf"), "rank", "node"), "paths")
    for level in reversed(levels):
        found = staged(found.union(found.join(level, ["tree", "node"]).select("tree", "leaf", "rank", "up")), "paths")
    return found.join(placed.select("tree", "node", "depth"), ["tree", "node"])


def formatted(messages: DataFrame, *, tree_col: str = "conv_id", node_col: str = "node", parent_col: str = "parent",
              role_col: str = "role", text_col: str = "text", score_col: str = "score", branches: int = 1,
              learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One conversation per chosen path: tree, ``leaf, rank, n_turns, formatted, loss_mask``.

    ``loss_mask`` lists the (start, length) spans, in code points of ``formatted``, of the
    escaped texts of ``learned`` roles. A message whose parent is null or not in its tree
    is a root. Messages that share tree and id are one, the smallest by parent, role and text;
    those without an id, or below a cycle of parents, are on no path. Null texts and
    roles are empty, null scores 0, null trees one tree; equal scores rank by id. An
    empty table gives no rows, other columns are not looked at.
    """
    nodes = staged(_nodes(messages, tree_col, node_col, parent_col, role_col, text_col, score_col), "messages")
    turns = paths(nodes, branches).join(nodes.drop("parent", "score"), ["tree", "node"])
    written = turns.select(
        "tree", "leaf", "rank", "depth", "role", F.concat(F.lit("### "), escaped(F.col("role"), ":"), F.lit(": ")).alias("head"),
        escaped(F.col("text")).alias("body")).withColumn("size", (
            F.length("head") + F.length("body") + len(END)).cast("long"))
    so_far = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = written.withColumn("start", F.coalesce(F.sum("size").over(so_far), F.lit(0)) + F.length("head"))
    turn = F.struct("depth", F.concat("head", "body", F.lit(END)).alias("line"), "start",
                    F.length("body").cast("long").alias("length"), F.col("role").isin(*learned).alias("learned"))
    kind = messages.schema[tree_col].dataType
    return (placed.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .select(F.nullif(F.col("tree"), F.lit(_NULL)).cast(kind).alias(tree_col), "leaf", "rank",
                    F.size("turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"),
                    F.transform(F.filter("turns", lambda t: t["learned"]),
                                lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))
                                ).alias("loss_mask")))


def read_back(conversations: DataFrame, *, formatted_col: str = "formatted", mask_col: str = "loss_mask") -> DataFrame:
    """Adds ``turns`` (role, text) and ``learned`` (texts under the mask), parsed from the formatted text alone."""
    lines = F.split(F.regexp_replace(F.col(formatted_col), r"(?s) </turn>\n\z", ""), " </turn>\n")
    # with each escaped pair blanked out, the first ": " ends the head; no group under a star, which Java would
    # match by recursion, one level per character
    placed = F.transform(lines, lambda line: F.struct(
        line.alias("line"), F.instr(F.regexp_replace(line, r"(?s)\\.", "  "), ": ").alias("at")))
    turns = F.transform(placed, lambda p: F.struct(
        unescaped(F.substr(p["line"], F.lit(5), p["at"] - 5)).alias("role"),
        unescaped(F.substr(p["line"], p["at"] + 2)).alias("text")))
    wide = conversations.withColumn("__points", F.encode(F.col(formatted_col), "UTF-32"))
    span = lambda s: F.decode(F.substring(
        F.col("__points"), (s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")), "UTF-32")
    return wide.withColumn("turns", turns).withColumn(
        "learned", F.transform(F.col(mask_col), lambda s: unescaped(span(s)))).drop("__points")
