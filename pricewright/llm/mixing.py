"""Mixing sources to target weights by the cube method.

Targets follow from source totals by water filling. Within a source every
document has the same expected number of copies, a whole part and a fraction.
The fractions are moved along the null space of two constraints, the source's
words and its documents, until each is 0 or 1: three undecided documents leave
one direction in which both totals stay as they are, and a random step along it
decides at least one of them.

The flight runs in blocks of a source, so a hot source is many groups. Each block
leaves at most ``LANDING`` undecided documents; these meet in the blocks of the next
level, whose number shrinks by ``BLOCK / LANDING`` each time. The last few of a source
are the landing: of all their subsets the one nearest to both totals is taken.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.llm import marks
from pricewright.llm.ship import shipped
from pricewright.staging import staged

WEIGHTS = (3, 1, 2)
SHARE, CEILING = 1.5, 2.0
BLOCK = 4096
LANDING = 12
SEED = 7


def n_words(text: str) -> Column:
    """Runs without white space in a text; null has none."""
    return F.coalesce(F.size(F.array_remove(F.split(F.col(f"`{text}`"), r"[ \t\n\x0B\f\r]+"), "")),
                      F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            ceiling: float = CEILING) -> DataFrame:
    """``source_no, source, source_size, target``: one row per source.

    Sources in code point order, null last, take ``weights`` in turn. They share ``share``
    of all words by weight; a target stops at ``ceiling`` times its source, and the
    excess goes to the others. With the sources ordered by the level at which they
    fill up, the common level is the largest of (budget - filled) / (weight not
    filled) over all prefixes.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1)
    filled = ranked.withColumn("weight", weight.cast("double")).withColumn(
        "cap", ceiling * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reach = ((share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return filled.withColumn("reach", reach).select(
        "source_no", "source", "source_size",
        F.least("cap", F.col("weight") * F.max("reach").over(every)).alias("target"))


def _step(p: list[float], x: list[float], u: tuple, at: list[int], rng) -> None:
    """Move the chances at ``at`` along ``u`` or against it until one is 0 or 1; the mean move is none."""
    ahead = min((1 - p[k]) / d if d > 0 else p[k] / -d for k, d in zip(at, u) if d)
    back = min(p[k] / d if d > 0 else (1 - p[k]) / -d for k, d in zip(at, u) if d)
    move = ahead if rng.random() * (ahead + back) < back else -back
    for k, d in zip(at, u):
        p[k] = min(1.0, max(0.0, p[k] + move * d))
        if p[k] < 1e-9 or p[k] > 1 - 1e-9:
            p[k] = float(round(p[k]))


def flight(chance: np.ndarray, size: np.ndarray, leave: int, rng) -> np.ndarray:
    """Chances after the flight; at most ``max(leave, 2)`` are neither 0 nor 1, and both totals are kept."""
    p, x = chance.astype(float).tolist(), size.astype(float).tolist()
    waiting = [k for k in range(len(p)) if 0 < p[k] < 1]
    pool: list[int] = []
    while len(pool) + len(waiting) > max(leave, 2):
        while len(pool) < 3:
            pool.append(waiting.pop())
        a, b, c = pool
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        _step(p, x, u if any(u) else (1.0, -1.0, 0.0), pool, rng)
        pool = [k for k in pool if 0 < p[k] < 1]
    return np.array(p)


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decides the last few: the subset nearest to the words, then the documents, they stand for."""
    open_ = np.flatnonzero((chance > 0) & (chance < 1))
    if not len(open_):
        return chance
    subsets = np.array(list(itertools.product((0.0, 1.0), repeat=len(open_))))
    left, x = chance[open_], size[open_].astype(float)
    cost = np.abs((subsets - left) @ x) + 0.05 * x.mean() * np.abs((subsets - left).sum(axis=1))
    out = chance.copy()
    out[open_] = subsets[cost.argmin()]
    return out


def _decide(level: int, seed: int):
    def run(key, rows):
        rows = rows.combine_chunks().sort_by([("place", "ascending"), ("size", "ascending")])
        last = rows.column("last")[0].as_py()
        rng = np.random.default_rng([seed, level, *(k.as_py() for k in key)])
        chance, size = rows.column("chance").to_numpy(), pc.multiply(rows.column("size"), rows.column("rows")).to_numpy()
        moved = flight(chance, size, LANDING, rng)
        moved = landing(moved, size) if last else moved
        rows = rows.drop_columns(["block", "last"])
        return rows.set_column(rows.schema.get_field_index("chance"), "chance", pa.array(moved, pa.float64()))
    return run


def mixture(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING,
            block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Words to take of every document: id, ``size, source_size, target, taken``.

    ``size`` counts runs without white space (null text: 0), ``target`` is the share of the
    document's source, ``taken`` is the size times 0, 1 or 2 copies. The copies of a source
    sum to its target up to the landing of its last few documents. The same table and
    seed give the same result however it is partitioned.

    Null sources are one source, the last. Documents without words have nothing to
    take. Rows equal in id, source and size are decided together and each keeps its row;
    null ids are allowed. An empty table gives no rows. Other columns are not looked at.
    """
    sizes = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                        n_words(text_col).alias("size"))
    out = _decisions(sizes, weights, share, ceiling, block, seed)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken",
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("__row")).drop("__row")


def _decisions(sized: DataFrame, weights: tuple[int, ...], share: float, ceiling: float, block: int,
               seed: int) -> DataFrame:
    """``id, source, size, rows, source_size, target, whole, taken``, one row per distinct id, source and size."""
    if block < 2 * LANDING:
        raise ValueError(f"block must be {2 * LANDING} or more")
    shipped(sized.sparkSession)
    sizes = staged(sized.groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    goal = staged(targets(sizes.select("source", (F.col("size") * F.col("rows")).alias("size")),
                          weights, share, ceiling), "targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = sizes.join(goal, sizes["source"].eqNullSafe(goal["source"])).select(
        "id", sizes["source"], "size", "rows", "source_no", "source_size", "target", copies.alias("copies"))
    units = known.select("*", F.floor("copies").alias("whole"),
                         F.when(F.col("size") > 0, F.col("copies") - F.floor("copies")).otherwise(0.0).alias("chance"),
                         F.xxhash64("id", "size", F.lit(seed)).alias("place")).drop("copies")
    done, open_, level = [], staged(units, "units"), 0
    while True:
        done.append(open_.where("chance <= 0 OR chance >= 1"))
        open_ = open_.where("chance > 0 AND chance < 1")
        counts = staged(open_.groupBy("source_no").agg(F.count("*").alias("n")), "counts")
        if counts.isEmpty():
            break
        dealt = open_.join(counts, "source_no").withColumn("blocks", F.ceil(F.col("n") / block)).select(
            *open_.columns, F.pmod(F.xxhash64("place", F.lit(level)), F.col("blocks")).alias("block"),
            (F.col("blocks") == 1).alias("last"))
        open_ = staged(dealt.groupBy("source_no", "block").applyInArrow(
            _decide(level, seed), open_.schema), "flight")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    taken = (F.col("whole") + F.round("chance").cast("long")) * F.col("size")
    return out.select("id", "source", "size", "rows", F.col("source_size").cast("long").alias("source_size"),
                      "target", "whole", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING,
          block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The documents that the mix takes, with their columns and ``size, source_size, target, taken``.

    Columns of these names are replaced. No text moves for it: all documents of a source are taken equally often or
    once more, and by their place rows learn which; the row of each source is sent to every task.
    """
    rows = marks.placed(docs)
    sized = staged(rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                               n_words(text_col).alias("size"), *marks.PLACE), "sized")
    decided = staged(_decisions(sized.drop(*marks.PLACE), weights, share, ceiling, block, seed), "decided")
    more = decided.where("taken > whole * size").select("id", "source", "size")
    same = [sized[c].eqNullSafe(more[c]) for c in more.columns]
    places = sized.join(more, same[0] & same[1] & same[2], "left_semi").select(*marks.PLACE)
    sources = staged(decided.select(F.col("source").alias("__source"), "source_size", "target",
                                    F.col("whole").alias("__whole")).distinct(), "sources")
    own = rows.drop("source_size", "target", "taken").withColumn("size", n_words(text_col))
    marked = marks.with_mark(own, places, "__more")
    joined = marked.join(F.broadcast(sources), marked[source_col].eqNullSafe(sources["__source"]))
    taken = ((F.col("__whole") + F.col("__more").cast("long")) * F.col("size")).cast("long")
    return joined.withColumn("taken", taken).where("taken > 0").drop("__source", "__whole", "__more")
