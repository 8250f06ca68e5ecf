"""Exact quantiles of many columns at once, grouped or not, that never order a group in one task.

One aggregate of mergeable sketches (KLL, all columns of a row in the same scan) brackets each
wanted rank. One pass over the values then counts every gap between brackets as one row and every
value inside a bracket by itself, and the rows that hold the ranks are picked. While a rank can have
more than ``SMALL`` of these rows to choose from, its interval is first cut into ``CUTS`` ranges and only
the one that holds the rank, known from the counts per range, is kept; the few rows left are ordered. A
rank that falls into a gap, which the sketch's error makes possible, gets the gap as its bracket and is
counted again. NaN and infinite values count as missing.

Without groups there are a few numbers per column: they come to the driver and go into the next plan as
literals, so a call takes two passes and five jobs. Per-group brackets are written instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.functions.numeric import finite
from pricewright.staging import staged

#: size of a sketch, and the error of a rank it has with high confidence (2.3 / k^0.9)
SKETCH = 16_384
#: bracket half-width in ranks, in units of the sketch's error
MARGIN = 3.0
#: rows a rank is finally chosen from, and ranges an interval is cut into before that
SMALL, CUTS = 1_000_000, 1_000
#: cuts shrink an interval a thousandfold each, so doubles need far fewer rounds than this
ROUNDS = 64


def _error(sketch: int) -> float:
    return 2.3 / sketch ** 0.9


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), *,
                    names: Sequence[str] | None = None, sketch: int = SKETCH, margin: float = MARGIN,
                    small: int = SMALL) -> DataFrame:
    """Linear-interpolated quantiles of the present values of one column, one column per probability.

    Rows: ``by`` columns, then ``names`` (default ``q0, q1, ...``). A group
    without values has no row, except that an ungrouped call returns one row.
    Jobs run while the frame is built.
    """
    out = column_quantiles(df, [value], probs, by, names=names, sketch=sketch, margin=margin, small=small).drop("column")
    if by:
        return out
    return out.agg(*(F.max(c).alias(c) for c in out.columns))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), *,
                     names: Sequence[str] | None = None, sketch: int = SKETCH, margin: float = MARGIN,
                     small: int = SMALL) -> DataFrame:
    """The same for several columns: rows are ``by`` columns, ``column``, then ``names``; none for a column without values."""
    names = list(names or (f"q{i}" for i in range(len(probs))))
    groups = [f"_k{i}" for i in range(len(by))]
    keys = [*groups, "_col"]
    cells = df.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(by, groups)),
                      *(finite(F.col(f"`{c}`").cast("double")).alias(f"_v{i}") for i, c in enumerate(columns)))
    keep = _written if by else _local
    brackets, known = keep(_brackets(cells, groups, len(columns), probs, sketch, margin), "brackets")
    most = (max((r["_n"] for r in known), default=0) if known is not None
            else brackets.agg(F.max("_n")).first()[0] or 0)
    while True:
        counted = _counted(cells, brackets, known, groups, len(columns), len(probs))
        # what the brackets can hold, by the sketch's error on either side
        if most * min(1.0, 4 * (abs(margin) + 2) * _error(sketch) * len(probs)) > small:
            picked, rows = keep(_picked(staged(counted, "counted"), brackets, keys, probs, small), "picked")
        else:
            picked, rows = keep(_chosen(counted, _whole(brackets, keys, probs), keys), "picked")
        if not any(r["_low"] < r["_high"] for r in rows) if rows is not None else picked.where("_low < _high").isEmpty():
            break
        brackets, known = keep(_widened(brackets, picked, keys, len(probs)), "brackets")
    out = _interpolated(picked, brackets, keys, probs, names)
    label = F.array(*map(F.lit, columns))[F.col("_col")] if columns else F.lit(None).cast("string")
    return out.select(*(F.col(k).alias(c) for k, c in zip(groups, by)), label.alias("column"), *names)


def _written(frame: DataFrame, label: str) -> tuple[DataFrame, None]:
    """Rows per group, of which there may be many."""
    return staged(frame, label), None


def _local(frame: DataFrame, label: str) -> tuple[DataFrame, list]:
    """A handful of rows, a few per column: as literals of the plans that follow, and as they are."""
    rows, kinds = frame.collect(), frame.schema
    one = frame.sparkSession.range(1)
    if not rows:
        return one.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kinds)).limit(0), rows
    literal = lambda value, kind: (F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)).cast(kind)
    return F.broadcast(one.select(F.inline(F.array(*(
        F.struct(*(literal(r[f.name], f.dataType).alias(f.name) for f in kinds)) for r in rows))))), rows


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys, nulls alike."""
    return reduce(Column.__and__, (left[k].eqNullSafe(right[k]) for k in keys), F.lit(True))


def _brackets(cells: DataFrame, groups: list[str], width: int, probs: Sequence[float], sketch: int, margin: float) -> DataFrame:
    """Per group and column: count and, for each probability, two values its rank should lie between."""
    wide = margin * _error(sketch)
    ranks = lambda side: F.array(*(F.lit(min(1.0, max(0.0, p + side * wide))) for p in probs))
    found = cells.groupBy(*groups).agg(*(agg for i in range(width) for agg in (
        F.count(f"_v{i}").alias(f"_n{i}"), F.kll_sketch_agg_double(f"_v{i}", F.lit(sketch)).alias(f"_s{i}"))))
    cut = lambda i, side: F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(
        F.col(f"_s{i}"), ranks(side)))
    return found.select(*groups, F.inline(F.array(*(F.struct(
        F.lit(i).alias("_col"), F.col(f"_n{i}").alias("_n"), cut(i, -1).alias("_lo"), cut(i, 1).alias("_hi"))
        for i in range(width))))).where("_n > 0")


def _located(cells: DataFrame, brackets: DataFrame, known: list | None, groups: list[str],
             width: int) -> tuple[DataFrame, list[tuple]]:
    """Rows beside their group's brackets, and per column the bracket columns."""
    if known is not None:
        at = {r["_col"]: r for r in known}
        literal = lambda i, c: F.array(*map(F.lit, at[i][c])) if i in at else F.lit(None).cast("array<double>")
        return cells, [(literal(i, "_lo"), literal(i, "_hi")) for i in range(width)]
    per = brackets.groupBy(*groups).agg(*(
        F.max(F.when(F.col("_col") == i, F.col(c))).alias(f"{c}{i}") for i in range(width) for c in ("_lo", "_hi")))
    places = [(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(width)]
    return cells.join(per, _same(cells, per, groups)).select(
        *(cells[c] for c in cells.columns), *(c for p in places for c in p)), places


def _counted(cells: DataFrame, brackets: DataFrame, known: list | None, groups: list[str], width: int, k: int) -> DataFrame:
    """``_low, _high, _c``: each value inside a bracket, and each gap between brackets as one row."""
    rows, places = _located(cells, brackets, known, groups, width)

    def entry(i: int) -> Column:
        v, (lo, hi) = F.col(f"_v{i}"), places[i]
        passed = sum(((v > hi[j]).cast("int") for j in range(k)), F.lit(0))
        inside = reduce(Column.__or__, ((v >= lo[j]) & (v <= hi[j]) for j in range(k)), F.lit(False))
        return F.struct(F.lit(i).alias("_col"), passed.alias("_seg"), F.when(inside, v).alias("_own"), v.alias("_v"))

    each = rows.select(*groups, F.inline(F.array(*map(entry, range(width))))).where("_v IS NOT NULL")
    keys = [*groups, "_col"]
    return each.groupBy(*keys, "_seg", "_own").agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_c")).select(*keys, "_low", "_high", "_c")


def _targets(brackets: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Two ranks per probability, those that the quantile lies between, over all values."""
    position = [F.floor((F.col("_n") - 1) * F.lit(float(p))) for p in probs]
    ranks = F.array(*(F.least(r + step, F.col("_n") - 1) for r in position for step in (0, 1)))
    return brackets.select(*keys, F.posexplode(ranks).alias("_t", "_rank"))


def _whole(brackets: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Every target with all values as its interval."""
    return _targets(brackets, keys, probs).select(
        *keys, "_t", "_rank", F.lit(float("-inf")).alias("_from"), F.lit(float("inf")).alias("_to"),
        F.lit(0).cast("long").alias("_below"))


def _picked(counted: DataFrame, brackets: DataFrame, keys: list[str], probs: Sequence[float], small: int) -> DataFrame:
    """``_t, _low, _high``: the counted row that holds each target rank."""
    state = _whole(brackets, keys, probs)
    left = counted.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    span = counted.groupBy(*keys).agg(F.min("_low").alias("_first"), F.max("_low").alias("_last"))
    if left > small:
        state = staged(state.join(span, _same(state, span, keys)).select(
            *(state[k] for k in keys), "_t", "_rank", F.col("_first").alias("_from"), F.col("_last").alias("_to"),
            "_below"), "narrow")
    for _ in range(ROUNDS):
        if left <= small:
            break
        narrowed = staged(_narrowed(counted, state, keys), "narrow")
        left = narrowed.agg(F.max("_rows")).first()[0] or 0
        state = narrowed.drop("_rows")
    return _chosen(counted, state, keys)


def _chosen(counted: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that hold the targets, from those inside their intervals, in order."""
    near = _inside(counted, state, keys)
    order = Window.partitionBy(*keys, "_t").orderBy("_low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = near.withColumn("_cum", F.col("_below") + F.sum("_c").over(order)).where("_cum > _rank")
    # the first and the last rank of a gap are known without its values
    known = F.when(F.col("_rank") == F.col("_cum") - F.col("_c"), F.col("_low")).when(
        F.col("_rank") == F.col("_cum") - 1, F.col("_high"))
    row = F.struct(F.col("_low").alias("_order"), F.coalesce(known, "_low").alias("_low"),
                   F.coalesce(known, "_high").alias("_high"))
    return reached.groupBy(*keys, "_t").agg(F.min(row).alias("_p")).select(*keys, "_t", "_p._low", "_p._high")


def _inside(counted: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Counted rows beside each target of their group whose interval they are in."""
    return counted.join(state, _same(counted, state, keys) & counted["_low"].between(state["_from"], state["_to"])
                        ).select(*(counted[c] for c in counted.columns), "_t", "_rank", "_from", "_to", "_below")


def _narrowed(counted: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Each target's interval cut down to the range, of ``CUTS`` equal ones, that holds its rank."""
    width = F.col("_to") - F.col("_from")
    cut = F.when(width > 0, F.least(F.floor((F.col("_low") - F.col("_from")) / width * CUTS), F.lit(CUTS))).otherwise(0)
    ranges = _inside(counted, state, keys).groupBy(*keys, "_t", "_rank", "_below", cut.alias("_cut")).agg(
        F.sum("_c").alias("_c"), F.count("*").alias("_rows"), F.min("_low").alias("_from"), F.max("_low").alias("_to"))
    # at most CUTS + 1 rows per target, however many values there are
    order = Window.partitionBy(*keys, "_t").orderBy("_cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = ranges.withColumn("_cum", F.col("_below") + F.sum("_c").over(order)).where("_cum > _rank")
    return reached.groupBy(*keys, "_t", "_rank").agg(F.min(F.struct(
        "_cut", "_from", "_to", (F.col("_cum") - F.col("_c")).alias("_below"), "_rows")).alias("_p")).select(
        *keys, "_t", "_rank", "_p._from", "_p._to", "_p._below", "_p._rows")


def _widened(brackets: DataFrame, picked: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Brackets whose ranks fell into a gap, widened over the gap. They only grow, so each misses a few times at most."""
    missed = picked.groupBy(*keys).agg(*(
        f(F.when((F.floor(F.col("_t") / 2) == j) & (F.col("_low") < F.col("_high")), F.col(c))).alias(f"{c}{j}")
        for j in range(k) for f, c in ((F.min, "_low"), (F.max, "_high"))))
    both = brackets.join(missed, _same(brackets, missed, keys))
    # least and greatest pass over the NULLs of brackets that held
    lo = F.array(*(F.least(F.col("_lo")[j], F.col(f"_low{j}")) for j in range(k)))
    hi = F.array(*(F.greatest(F.col("_hi")[j], F.col(f"_high{j}")) for j in range(k)))
    return both.select(*(brackets[c] for c in keys), "_n", lo.alias("_lo"), hi.alias("_hi"))


def _interpolated(picked: DataFrame, brackets: DataFrame, keys: list[str], probs: Sequence[float],
                  names: list[str]) -> DataFrame:
    sides = picked.groupBy(*keys).agg(*(
        F.max(F.when(F.col("_t") == t, F.col("_low"))).alias(f"_r{t}") for t in range(2 * len(probs))))
    both = brackets.join(sides, _same(brackets, sides, keys), "left").select(
        *(brackets[c] for c in keys), "_n", *(f"_r{t}" for t in range(2 * len(probs))))

    def between(j: int, p: float, name: str) -> Column:
        position = (F.col("_n") - 1) * F.lit(float(p))
        share = position - F.floor(position)
        a, b = F.col(f"_r{2 * j}"), F.col(f"_r{2 * j + 1}")
        return F.when(share == 0, a).otherwise(a + (b - a) * share).alias(name)

    return both.select(*keys, *(between(j, p, name) for j, (p, name) in enumerate(zip(probs, names))))
