"""The trie of conversation prefixes, built by union-find over sorted neighbours.

A turn is a letter, a 128-bit digest of role and text. Conversations are cut into chunks of
``CHUNK`` turns; a chunk belongs to the root that all turns before it make up, so a
conversation of any length is many small rows, and every root has a trie of its own
of bounded depth. Equal chunks of one root fold into one row with sums of its conversations.

Rows are sorted by (root, letters) into ranges. The prefix that neighbours share is an edge
between them. Inside a range the edges are taken in descending depth: an edge of depth d
unites two components, and what comes of it is a branching node of depth d. A component
that has reached depth t and is united at d < t stands for the unbranched nodes
d + 1 to t, whose members are its rows. The neighbours just outside a range take
part as ghosts: a component with a ghost is open, its nodes go on in other
ranges. Open nodes, a path on either side of each range, are what a range is contracted
to; two ranges' open nodes are one if root, depth and prefix agree, which is what the edge
across their boundary says, so that merge is a grouped sum over open nodes only.

All figures of a node are sums or minima over its rows. ``saved`` counts (members - 1) times
the size of the last turn, summed over the subtree: the sizes of all members' turns
from this depth on, less the sizes of the distinct nodes. Distinct nodes are counted where
their first row lies; of chunks further down, with their smallest member, whose
chunks above then carry the count. That needs a pass over the later chunks first, taken
only if there are any.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pricewright.llm.ship import shipped
from pricewright.staging import staged

#: Turns of a chunk, and rows of a range, about.
CHUNK, RANGE = 64, 20_000
#: Bytes of a letter, and how much of role and text orders turns of one number before their digest does.
LETTER, TIE = 16, 256


class Trie(NamedTuple):
    """``nodes`` (one row per distinct prefix) and ``ends`` (``conv``, and the ``end`` of the node it ends at)."""

    nodes: DataFrame
    ends: DataFrame


def _digest(*parts: Column | str) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat_ws(":", *parts), 256)), 1, LETTER)


def _ranges(rows: int, spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // RANGE + 1)


def _counted(batches):
    """Numbers the rows of each conversation within a sorted partition."""
    last, n = None, 0
    for batch in batches:
        convs = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(convs):
            continue
        fresh = np.flatnonzero(np.append(True, convs[1:] != convs[:-1]))
        place = np.arange(len(convs)) - np.repeat(fresh, np.diff(np.append(fresh, len(convs)))) + 1
        if convs[0] == last:
            place[:fresh[1] if len(fresh) > 1 else None] += n
        last, n = convs[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "within"])


def lettered(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``conv, place, letter, size``: each turn as a digest of role and text, numbered from 1 in its conversation.

    Turns go by number, null first; those of one number by the first ``TIE`` characters of role and of text, then
    by digest. A null role or text is empty; rows without a conversation are left out. ``size`` is the number of
    the text's code points. No task holds a conversation: rows are sorted into ranges and numbered there, and a
    conversation that spans ranges gets the counts of those before.
    """
    spark = shipped(turns.sparkSession)
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    light = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.left(role, F.lit(TIE)).alias("role"), F.left(text, F.lit(TIE)).alias("text"),
        _digest(F.length(role).cast("string"), role, text).alias("letter"), F.length(text).cast("long").alias("size"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "letter"]
    ranged = light.repartitionByRange(_ranges(turns.count(), spark), *order).sortWithinPartitions(*order).select(
        "conv", "letter", "size", F.spark_partition_id().alias("range"))
    rows = staged(ranged.mapInArrow(_counted, T.StructType(
        [*ranged.schema.fields, T.StructField("within", T.LongType())])), "letters")
    parts = staged(rows.groupBy("conv", "range").agg(F.max("within").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(
            Window.unboundedPreceding, -1))).where("before IS NOT NULL").select("conv", "range", "before"), "offsets")
    return rows.join(parts, ["conv", "range"], "left").select(
        "conv", (F.col("within") + F.coalesce("before", F.lit(0))).alias("place"), "letter", "size")


def _chunks(letters: DataFrame, convs: DataFrame, chunk: int) -> DataFrame:
    """``conv, level, letters, sizes, last, root, rest``; a conversation without turns has one empty chunk.

    ``root`` is empty at level 0, else a digest of the chunks before; ``rest`` sums the sizes from this chunk on.
    """
    level = F.floor((F.col("place") - 1) / chunk).cast("long")
    turn = F.struct("place", F.hex("letter").alias("letter"), "size")
    cut = letters.groupBy("conv", level.alias("level")).agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv", "level", F.unhex(F.array_join(F.transform("turns", lambda t: t["letter"]), "")).alias("letters"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"))
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    lane = lambda k: F.conv(F.substring("h", 15 * k + 1, 15), 16, 10).cast("decimal(38,0)")
    cut = staged(cut.withColumn("own", sizes).withColumn("h", F.sha2(F.concat(
        F.col("level").cast("string").cast("binary"), F.lit(b":"), "letters"), 256)).select(
        "conv", "level", "letters", "sizes", "own", lane(0).alias("a"), lane(1).alias("b")), "chunks")
    whole = Window.partitionBy("conv").orderBy("level")
    before, after = whole.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv").orderBy(
        F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    empty = convs.join(cut.where("level = 0").select("conv"), "conv", "left_anti").select(
        "conv", F.lit(0).cast("long").alias("level"), F.lit(b"").alias("letters"),
        F.array().cast("array<bigint>").alias("sizes"), F.lit(0).cast("long").alias("own"),
        *(F.lit(0).cast("decimal(38,0)").alias(c) for c in "ab"))
    return cut.unionByName(empty).withColumn("rest", F.sum("own").over(after)).withColumn(
        "last", F.lead("level").over(whole).isNull()).withColumn("root", F.when(
            F.col("level") == 0, F.lit(b"")).otherwise(_digest(
                F.col("level").cast("string"), *(F.sum(c).over(before).cast("string") for c in "ab")))).drop(
        "own", "a", "b")


def _folded(chunks: DataFrame) -> DataFrame:
    """Equal chunks of a root as one row: members, smallest member, sums, the next root, and whether any ends here."""
    return chunks.groupBy("root", "level", "letters").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("members"), F.min("conv").alias("least"),
        F.sum("rest").alias("rest"), F.sum("below").alias("below"), F.sum("leaves").alias("leaves"),
        F.max("next").alias("next"), F.max("last").alias("ends"))


_NODE = T.StructType([T.StructField(n, k) for n, k in (
    ("key", T.BinaryType()), ("parent_key", T.BinaryType()), ("level", T.LongType()), ("depth", T.LongType()),
    ("conv_id", T.LongType()), ("parent_conv_id", T.LongType()), ("n_convs", T.LongType()),
    ("n_children", T.LongType()), ("n_leaves", T.LongType()), ("saved", T.LongType()), ("size", T.LongType()),
    ("next", T.BinaryType()), ("end", T.BinaryType()))])


def _key(root: bytes, letters: bytes) -> bytes:
    """Names a prefix, the root and the letters after it; ``_named`` is the same for columns."""
    return hashlib.sha256(b"%d:" % len(root) + root + letters).digest()[:LETTER]


def _named(root: str, letters: str) -> Column:
    size = F.concat(F.octet_length(root).cast("string"), F.lit(":")).cast("binary")
    return F.substring(F.unhex(F.sha2(F.concat(size, F.col(root), F.col(letters)), 256)), 1, LETTER)


def _shared(letters: list[bytes], roots: list[bytes]) -> np.ndarray:
    """Turns that each row has in common with the row before it; -1 if their roots differ."""
    n = np.array([len(x) // LETTER for x in letters])
    out = np.full(len(letters), -1, dtype=np.int64)
    for low in range(1, len(letters), 4096):
        high = min(low + 4096, len(letters))
        wide = max(1, int(n[low - 1:high].max()))
        grid = np.zeros((high - low + 1, wide * LETTER), dtype=np.uint8)
        for i in range(low - 1, high):
            own = np.frombuffer(letters[i], dtype=np.uint8)
            grid[i - low + 1, :len(own)] = own
        same = (grid[1:] == grid[:-1]).reshape(high - low, wide, LETTER).all(axis=2)
        run = np.where(same.all(axis=1), wide, same.argmin(axis=1))
        out[low:high] = np.minimum(run, np.minimum(n[low:high], n[low - 1:high - 1]))
    out[[i for i in range(1, len(roots)) if roots[i] != roots[i - 1]]] = -1
    return out


class _Forest:
    """Union-find over the sorted rows of one range; united components leave segments of equal members."""

    def __init__(self, depth, members, least, rest, distinct, leaves, ghost):
        n = len(depth)
        self.up = list(range(n))
        self.first = list(range(n))
        self.real = list(range(n))  # a row that is no ghost, once there is one
        self.top = depth.tolist()
        self.kids = [0] * n
        self.branch = [-1] * n
        self.open = ghost.tolist()
        self.ghost = ghost.tolist()
        self.sums = [list(x) for x in zip(members.tolist(), rest.tolist(), distinct.tolist(), leaves.tolist())]
        self.least = least.tolist()
        self.segments: list[tuple] = []
        self.of_branch: list[int] = []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def leave(self, c: int, above: int, parent: int) -> None:
        """Component ``c`` stood for the nodes of depth ``above`` + 1 to its top."""
        if self.branch[c] >= 0:
            self.of_branch[self.branch[c]] = len(self.segments)
        if self.sums[c][0]:
            self.segments.append((self.real[c], above + 1, self.top[c], self.kids[c], self.least[c], *self.sums[c],
                                  self.open[c], parent, not self.ghost[self.first[c]]))

    def close(self, c: int) -> None:
        """The root, of depth 0, is a node of its own even if all rows share a turn."""
        if self.top[c]:
            self.of_branch.append(-1)
            self.leave(c, 0, len(self.of_branch) - 1)
            self.top[c], self.kids[c] = 0, int(not self.ghost[self.first[c]])
            self.branch[c] = len(self.of_branch) - 1
        self.leave(c, -1, -1)

    def unite(self, left: int, right: int, depth: int) -> None:
        a, b = self.find(left), self.find(right)
        at_depth = self.top[a] == depth
        branch = self.branch[a] if at_depth else -1
        if branch < 0:
            branch = len(self.of_branch)
            self.of_branch.append(-1)
        # a child counts in the range that holds its first row
        kids = self.kids[a] if at_depth else int(not self.ghost[self.first[a]])
        kids += int(not self.ghost[self.first[b]])
        if not at_depth:
            self.leave(a, depth, branch)
        self.leave(b, depth, branch)
        self.up[b] = a
        self.real[a] = self.real[a] if self.sums[a][0] else self.real[b]
        self.sums[a] = [x + y for x, y in zip(self.sums[a], self.sums[b])]
        self.least[a] = min(self.least[a], self.least[b])
        self.open[a] = self.open[a] or self.open[b]
        self.top[a], self.kids[a], self.branch[a] = depth, kids, branch


def _united(chunk: int):
    def run(table: pa.Table) -> pa.Table:
        """The nodes of one range of sorted rows."""
        cols = {c: table.column(c).to_pylist() for c in ("root", "letters", "next", "ghost")}
        order = sorted(range(len(table)), key=lambda i: (cols["root"][i], cols["letters"][i]))
        roots, letters, nexts, ghost = ([cols[c][i] for i in order] for c in ("root", "letters", "next", "ghost"))
        table = table.take(pa.array(order)).combine_chunks()
        ghost = np.array(ghost, dtype=bool)
        number = lambda c: table.column(c).to_numpy()
        depth = np.array([len(x) // LETTER for x in letters])
        shared = _shared(letters, roots)
        # sizes of the first turns of each row, end to end: so_far[at[i] + d] sums the first d
        at = np.concatenate(([0], np.cumsum(depth + 1)))
        flat = table.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        each = np.zeros(at[-1], dtype=np.int64)
        inner = np.ones(at[-1], dtype=bool)
        inner[at[:-1]] = False
        each[inner] = flat
        so_far = np.cumsum(each)
        so_far -= np.repeat(so_far[at[:-1]], depth + 1)
        known = np.maximum(shared, 0)
        distinct = np.where(ghost, 0, so_far[at[:-1] + depth] - so_far[at[:-1] + known] + number("below"))
        leaf = np.append(shared[1:], -1) < depth
        leaf &= np.array([x is None for x in nexts])
        leaves = np.where(ghost, 0, leaf + number("leaves"))
        least = np.where(ghost, np.iinfo(np.int64).max, number("least"))
        forest = _Forest(depth, np.where(ghost, 0, number("members")), least,
                         np.where(ghost, 0, number("rest")), distinct, leaves, ghost)
        edges = np.flatnonzero(shared >= 0)
        for i in edges[np.argsort(-shared[edges], kind="stable")].tolist():
            forest.unite(i - 1, i, int(shared[i]))
        for c in range(len(order)):
            if forest.up[c] == c:
                forest.close(c)
        return _nodes_of(forest, chunk, roots, letters, nexts, number("level"), table.column("ends").to_pylist(),
                         depth, at, so_far, shared)
    return run


def _nodes_of(forest: _Forest, chunk: int, roots, letters, nexts, level, ends, depth, at, so_far, shared) -> pa.Table:
    """Segments as one row per depth."""
    columns = list(zip(*forest.segments)) or [()] * 12
    row, low, high, kids, least, members, rest, distinct, leaves, opened, parent, starts = (
        np.array(x, dtype=np.int64) for x in columns)
    opened, starts = opened.astype(bool), starts.astype(bool)
    width = high - low + 1
    seg = np.repeat(np.arange(len(row)), width)
    d = np.arange(len(seg)) - np.repeat(np.cumsum(width) - width, width) + low[seg]
    i = row[seg]
    is_open = opened[seg] | (d == 0)
    before = so_far[at[i] + np.maximum(d - 1, 0)]
    # nodes above this depth that the first row holds alone are no part of the subtree
    above = np.where(starts[seg], before - so_far[at[i] + np.minimum(np.maximum(shared[i], 0), np.maximum(d - 1, 0))], 0)
    saved = rest[seg] - members[seg] * before - (distinct[seg] - above)
    size = so_far[at[i] + d] - before
    of_branch = np.array([*forest.of_branch, -1], dtype=np.int64)
    over = of_branch[parent[seg]]
    same = d > low[seg]
    parent_open = np.where(same, opened[seg] | (d == 1), (d > 0) & (opened[over] | (d == 1)))
    parent_conv = np.where(same, least[seg], least[over]) if len(seg) else np.empty(0, np.int64)
    whole = (d == depth[i]) & starts[seg]
    keys: dict[tuple, bytes] = {}

    def key(r: int, n: int) -> bytes:
        name = (r, n) if n else roots[r]
        if name not in keys:
            keys[name] = _key(roots[r], letters[r][:n * LETTER])
        return keys[name]
    picked = lambda mask, make: [make(r, n) if m else None for m, r, n in zip(
        mask.tolist(), i.tolist(), d.tolist())]
    parent_row = np.where(same, i, row[over] if len(seg) else i).tolist()
    return pa.table([
        pa.array(picked(is_open, key), pa.binary()),
        pa.array([key(r, n - 1) if m else None for m, r, n in zip(parent_open.tolist(), parent_row, d.tolist())], pa.binary()),
        pa.array(level[i]), pa.array(d + chunk * level[i]), pa.array(least[seg]),
        pa.array(parent_conv, mask=parent_open | (d == 0)), pa.array(members[seg]),
        pa.array(np.where(d == high[seg], kids[seg], starts[seg])), pa.array(leaves[seg]), pa.array(saved), pa.array(size),
        pa.array(picked(whole, lambda r, n: nexts[r] and _key(nexts[r], b"")), pa.binary()),
        pa.array(picked(whole, lambda r, n: key(r, n) if ends[r] else None), pa.binary())],
        schema=pa.schema([(f.name, pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.int64())
                          for f in _NODE.fields]))


def _forest_nodes(rows: DataFrame, chunk: int) -> DataFrame:
    """All nodes of all roots, open ones merged, with parents; local roots of later levels included (``depth`` of their parent)."""
    rows = staged(rows, "folded")
    order = ["root", "letters"]
    ranged = staged(rows.repartitionByRange(_ranges(rows.count(), rows.sparkSession), *order).withColumn(
        "range", F.spark_partition_id()), "ranges")
    edge = F.struct(*order, "level", "sizes")
    bounds = ranged.groupBy("range").agg(F.min(edge).alias("low"), F.max(edge).alias("high"))
    by = Window.orderBy("range")
    sides = bounds.select("range", F.lag("high").over(by).alias("before"), F.lead("low").over(by).alias("after"))
    ghosts = staged(sides.select("range", F.explode(F.array("before", "after")).alias("g")).where(
        "g IS NOT NULL").select("range", "g.*"), "ghosts")
    ghosts = ghosts.select(
        *order, "level", "sizes", "range", *(F.lit(0).cast("long").alias(c) for c in (
            "members", "least", "rest", "below", "leaves")), F.lit(None).cast("binary").alias("next"),
        F.lit(False).alias("ends"), F.lit(True).alias("ghost"))
    own = ranged.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    found = staged(own.groupBy("range").applyInArrow(_united(chunk), _NODE), "nodes")
    total = lambda c: F.sum(c).alias(c)
    merged = staged(found.where("key IS NOT NULL").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("level").alias("level"), F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"), total("n_leaves"), total("saved"),
        F.max("size").alias("size"), F.max("next").alias("next"), F.max("end").alias("end")), "open")
    # the parent of a later root's first turns is the node above that root, not the root itself
    inner = found.where("key IS NULL").select("conv_id", "next").union(merged.select("conv_id", "next"))
    names = merged.where("level = 0").select("key", "conv_id").union(
        merged.where(F.col("depth") > F.col("level") * chunk).where("level > 0").select("key", "conv_id")).union(
        inner.where("next IS NOT NULL").select("next", "conv_id")).toDF("parent_key", "named")
    closed = found.where("key IS NULL")
    known = closed.where("parent_key IS NULL").drop("parent_key")
    asked = closed.where("parent_key IS NOT NULL").drop("parent_conv_id").unionByName(
        merged.where("parent_key IS NOT NULL")).join(names, "parent_key", "left").withColumnRenamed(
        "named", "parent_conv_id").drop("parent_key")
    roots = merged.where("parent_key IS NULL").drop("parent_key").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return known.unionByName(asked).unionByName(roots)


def _joined(nodes: DataFrame, chunk: int) -> DataFrame:
    """Levels put together: the last node of a chunk has the next root's children, and later roots go."""
    nodes = staged(nodes, "levels")
    later = F.col("depth") == F.col("level") * chunk
    roots = nodes.where("level > 0").where(later).select(F.col("key").alias("next"), "n_children")
    onward = nodes.where("next IS NOT NULL").drop("n_children").join(roots, "next")
    return nodes.where("next IS NULL").where((F.col("level") == 0) | ~later).unionByName(onward)


def _below(chunks: DataFrame, chunk: int) -> DataFrame:
    """The chunks with what later chunks of their conversation hold: sizes of nodes it is the smallest member of, and leaves."""
    later = _folded(chunks.where("level > 0"))
    nodes = _forest_nodes(later, chunk).where(F.col("depth") > F.col("level") * chunk)
    held = nodes.groupBy(F.col("conv_id").alias("conv"), "level").agg(
        F.sum("size").alias("held"), F.count_if(F.col("next").isNull() & (F.col("n_children") == 0)).alias("tips"))
    after = Window.partitionBy("conv").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    rest = lambda c: F.coalesce(F.sum(c).over(after), F.lit(0))
    return chunks.drop("below", "leaves").join(held, ["conv", "level"], "left").withColumns(
        {"below": rest("held"), "leaves": rest("tips")}).drop("held", "tips")


def trie(letters: DataFrame, convs: DataFrame, *, chunk: int = CHUNK) -> Trie:
    """The trie of conversations given as ``conv, place, letter, size`` rows and all ``conv`` numbers.

    ``nodes``: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved``, and ``end``, null if no conversation ends there. ``ends``: ``conv`` and
    the ``end`` of its last node. The turn of a node is turn ``depth`` of conversation ``conv_id``. Conversations
    without turns are members of the root; with no conversations there are no nodes. Places run from 1 without gaps.
    """
    shipped(letters.sparkSession)
    none = F.lit(0).cast("long")
    onward = F.lead("root").over(Window.partitionBy("conv").orderBy("level"))
    chunks = staged(_chunks(letters, convs, chunk).withColumns(
        {"next": onward, "below": none, "leaves": none}), "rooted")
    if not chunks.where("level > 0").isEmpty():
        chunks = staged(_below(chunks, chunk), "rooted")
    nodes = _joined(_forest_nodes(_folded(chunks), chunk), chunk)
    return Trie(nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "end"),
                chunks.where("last").select("conv", _named("root", "letters").alias("end")))


def prefix_trie(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", chunk: int = CHUNK) -> Trie:
    """The trie of a table of turns, as ``trie``; see ``lettered`` for nulls, ties and repeated rows (all kept)."""
    letters = staged(lettered(turns, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col), "turns")
    return trie(letters, letters.select("conv").distinct(), chunk=chunk)
