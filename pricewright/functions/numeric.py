"""Numeric column helpers. All of them stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Modulus of the Lehmer generator and multipliers from
# Fishman & Moore (1986), one per independent use of a row key.
MODULUS = 2_147_483_647
TEST_STREAM = 950_706_376
FOLD_STREAM = 742_938_285
SIZE_STREAM = 1_226_874_159
BAG_STREAM = 62_089_911
SEED_MULTIPLIER = 48_271


def seed_offset(seed: int) -> int:
    """Neighbouring seeds land far apart."""
    return pow(SEED_MULTIPLIER, seed, MODULUS)


def bucket(key: Column | str, buckets: int, seed: int, stream: int) -> Column:
    """Deterministic bucket 0..buckets-1 of an integer key.

    Depends on the key only, so a split is the same whatever the partitioning,
    and a re-run task puts each row where it was before.
    """
    key = F.col(key) if isinstance(key, str) else key
    mixed = (F.pmod(key.cast("bigint"), F.lit(MODULUS)) * F.lit(stream).cast("bigint")
             + F.lit(seed_offset(seed))) % F.lit(MODULUS)
    return F.call_function("div", mixed * F.lit(buckets), F.lit(MODULUS).cast("bigint")) \
        .cast("int")


#: draws a bag weight is read from, and the greatest weight; a greater one has a chance of 1e-7
BAG_DRAWS, BAG_MOST = 1_000_000, 9


def bag_limits() -> list[int]:
    """Draws from which on a Poisson(1) weight is at least 1, 2, ..."""
    chances = [math.exp(-1) / math.factorial(k) for k in range(BAG_MOST)]
    return [round(sum(chances[:k + 1]) * BAG_DRAWS) for k in range(BAG_MOST)]


def bag_stream(tree: int) -> int:
    """Multiplier of a tree's draws: powers of one multiplier, so that no tree's draws are another's shifted."""
    return pow(BAG_STREAM, tree + 1, MODULUS)


def bag_weight(key: Column | str, tree: int, seed: int) -> Column:
    """How often a row is in the bootstrap sample of a tree: Poisson(1), by row key and tree alone."""
    draw = bucket(key, BAG_DRAWS, seed, bag_stream(tree))
    return sum(((draw >= limit).cast("double") for limit in bag_limits()), F.lit(0.0))


def drop_nan(column: Column) -> Column:
    """NaN becomes NULL: one kind of missing value, as NaN compares greater than anything."""
    return F.nanvl(column, F.lit(None).cast("double"))


def finite(column: Column) -> Column:
    """NaN and infinite values become NULL."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def parse_double(text: Column) -> Column:
    """Text to double, NULL where it is no number. Java's ``1.5d`` suffixes are no numbers."""
    # the pattern only runs on the few texts that end in such a letter
    suffixed = F.right(F.rtrim(text), F.lit(1)).isin("d", "D", "f", "F") & F.rtrim(text).rlike("[0-9.][dDfF]$")
    return drop_nan(F.when(~suffixed, text.try_cast("double")))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share in percent, half-even rounded; NULL for an empty whole."""
    return F.bround(F.try_divide(part * 100.0, whole.cast("double")), digits)


def unbiased_skew(column: Column) -> Column:
    """Bias-adjusted skewness (G1); NULL under three values, 0 for a constant."""
    n = F.count(column).cast("double")
    adjusted = F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2)
    return (F.when(n < 3, F.lit(None).cast("double"))
             .when(F.min(column) == F.max(column), F.lit(0.0))
             .otherwise(adjusted))


def r_squared(actual: Column, predicted: Column) -> Column:
    """1 - SSE/SST as one aggregate; NULL when the actual value is constant."""
    error = actual - predicted
    return 1 - F.try_divide(F.avg(error * error), F.var_pop(actual))


def compact_amount(column: Column) -> Column:
    """150000 -> '150k'; amounts under a thousand are printed whole."""
    return (F.when(F.abs(column) >= 1000, F.format_string("%.0fk", column / 1000))
             .otherwise(F.format_string("%.0f", column)))
