"""The tables behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.functions.numeric import finite, unbiased_skew
from pricewright.functions.quantiles import exact_quantiles
from pricewright.staging import staged


def _value(df: DataFrame, column: str, log: bool = False) -> DataFrame:
    """The column's values as ``_v``; missing, NaN and infinite ones have no place on an axis and are left out."""
    v = F.col(column).cast("double")
    return df.select(finite(F.log1p(v) if log else v).alias("_v")).filter("_v IS NOT NULL")


def histogram(df: DataFrame, column: str, bins: int = 60, *, log: bool = False) -> DataFrame:
    """Equal-width bins between min and max, empty bins included; the last one is closed.

    One pass finds the range (a scalar subquery), one counts: at most ``bins``
    rows per task are shuffled. A constant column gets a range of width one.
    """
    values = _value(df, column, log)
    span = values.agg(F.min("_v").alias("a"), F.max("_v").alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    located = values.select("_v", lo.alias("lo"), ((hi - lo) / bins).alias("width"))
    bin_of = F.least(F.floor((F.col("_v") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    counted = located.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return (df.sparkSession.range(bins).withColumnRenamed("id", "bin")
            .join(counted, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("n", F.lit(0)).alias("count")))


#: a Gaussian this many bandwidths away adds less than 1e-18 of its peak
_REACH = 9.2


def density(df: DataFrame, column: str, points: int = 200, *, log: bool = False) -> DataFrame:
    """Gaussian density with Scott's bandwidth on an even grid from min to max.

    Every value touches only the grid points its kernel reaches. The bandwidth
    shrinks with the row count, so the work per row does too; sums are folded
    before the shuffle, which carries at most ``points`` rows per task.
    """
    values = _value(df, column, log)
    stats = values.agg(F.count("_v").cast("double").alias("n"), F.min("_v").alias("lo"),
                       F.max("_v").alias("hi"), F.stddev_samp("_v").alias("sd"))
    n, lo, hi, sd = (stats.select(c).scalar() for c in ("n", "lo", "hi", "sd"))
    # a constant column has no step and no bandwidth: its density is NULL at every point
    step, width = F.nullif((hi - lo) / (points - 1), F.lit(0.0)), F.nullif(sd * F.pow(n, F.lit(-0.2)), F.lit(0.0))
    placed = values.select("_v", lo.alias("lo"), step.alias("step"), width.alias("h")) \
        .filter("h > 0 AND step > 0")
    reach = F.col("h") * _REACH
    first = F.greatest(F.ceil((F.col("_v") - reach - F.col("lo")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((F.col("_v") + reach - F.col("lo")) / F.col("step")), F.lit(points - 1))
    touched = placed.select("_v", "lo", "step", "h", F.explode(F.sequence(first, last)).alias("point"))
    z = (F.col("lo") + F.col("point") * F.col("step") - F.col("_v")) / F.col("h")
    summed = touched.groupBy("point").agg(F.sum(F.exp(z * z * -0.5)).alias("mass"))
    scale = n * width * F.sqrt(F.lit(2.0) * F.pi())
    return (df.sparkSession.range(points).withColumnRenamed("id", "point")
            .join(summed, "point", "left")
            .select("point", (lo + F.col("point") * F.coalesce(step, F.lit(0.0))).alias("x"),
                    (F.coalesce("mass", F.lit(0.0)) / scale).alias("density")))


def skew_pair(df: DataFrame, column: str) -> DataFrame:
    v = F.col(column).cast("double")
    return df.agg(unbiased_skew(v).alias("skew_raw"), unbiased_skew(F.log1p(v)).alias("skew_log"))


def monthly_trend(df: DataFrame, target: str, month: str = "Month") -> DataFrame:
    """Mean and sample deviation per month with the one-deviation band."""
    return (df.filter(F.col(month).isNotNull()).groupBy(month)
              .agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"))
              .withColumn("band_lo", F.col("mean") - F.col("std"))
              .withColumn("band_hi", F.col("mean") + F.col("std")))


# The months annotated on the trend.
PEAK_MONTHS = {4: "Eid-ul-Fitr", 7: "Eid-ul-Adha"}


def peak_months(trend: DataFrame, peaks: dict[int, str] = PEAK_MONTHS, month: str = "Month") -> DataFrame:
    """The trend rows of the annotated months; a month without data has none."""
    wanted = trend.sparkSession.createDataFrame(list(peaks.items()), f"`{month}` int, label string")
    return trend.join(F.broadcast(wanted), month).select(month, "label", "mean")


def group_medians(df: DataFrame, by: str, target: str) -> DataFrame:
    """Exact median per group."""
    return exact_quantiles(df.filter(F.col(by).isNotNull()), target, [0.5], [by], names=["median"])


def median_order(df: DataFrame, by: str, target: str) -> DataFrame:
    """Groups by median, highest first, with the median as a whole-number label."""
    return (group_medians(df, by, target)
            .withColumn("label", F.format_string("%,.0f", F.bround("median", 0)))
            .orderBy(F.desc("median"), by))


def box_stats(df: DataFrame, by: str, target: str) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and outliers per group."""
    rows = df.select(by, finite(F.col(target).cast("double")).alias("_v")).filter(
        F.col(by).isNotNull() & F.col("_v").isNotNull())
    quartiles = exact_quantiles(rows, "_v", [0.25, 0.5, 0.75], [by], names=["q1", "median", "q3"])
    # written, so that its size is known: a broadcast spares the rows a shuffle by group
    fenced = staged(quartiles.withColumn("_reach", (F.col("q3") - F.col("q1")) * 1.5), "quartiles")
    v = F.col("_v")
    inside = (v >= F.col("q1") - F.col("_reach")) & (v <= F.col("q3") + F.col("_reach"))
    return (rows.join(fenced, by).groupBy(by, "q1", "median", "q3")
            .agg(F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
                 F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("median"), by))


def group_summary(df: DataFrame, by: str, target: str) -> DataFrame:
    """Mean and row count per group, cheapest first."""
    return (df.filter(F.col(by).isNotNull()).groupBy(by)
              .agg(F.avg(target).alias("mean_fare"), F.count(target).alias("count"))
              .orderBy("mean_fare", by))


def top_by_count(df: DataFrame, by: str, k: int = 10) -> DataFrame:
    return (df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), by).limit(k))


def top_by_mean(df: DataFrame, by: str, target: str, k: int = 5) -> DataFrame:
    return (df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(target).alias("avg_fare"))
              .orderBy(F.desc("avg_fare"), by).limit(k))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form; NULL where a side of a pair does not vary.

    A first pass finds, per pair, whether both sides vary over the rows that have both, as ``corr`` divides by
    zero where one does not; the second takes all correlations. A NaN or infinite value counts as missing.
    """
    columns = [c for c in columns if c in df.columns]
    pairs = [(i, j) for j in range(len(columns)) for i in range(j + 1)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "i int, j int, x string, y string, corr double")
    cells = df.select(*(finite(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)))

    def varies(x: Column, y: Column) -> Column:
        both = F.when(y.isNotNull(), x)
        return F.min(both) < F.max(both)

    side = {(i, j): (F.col(f"_{i}"), F.col(f"_{j}")) for i, j in pairs}
    known = cells.agg(F.struct(*(
        (varies(x, y) & varies(y, x)).alias(f"v{i}_{j}") for (i, j), (x, y) in side.items())).alias("v"))
    marked = cells.withColumn("_v", known.scalar())
    wide = marked.agg(*(
        F.max(F.when(F.col(f"_v.v{i}_{j}"), 1.0)).alias(f"c{i}_{j}") if i == j else
        F.corr(F.when(F.col(f"_v.v{i}_{j}"), x), y).alias(f"c{i}_{j}") for (i, j), (x, y) in side.items()))

    def cell(i: int, j: int) -> Column:
        return F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(columns[i]).alias("x"),
                        F.lit(columns[j]).alias("y"), F.col(f"c{min(i, j)}_{max(i, j)}").alias("corr"))

    return wide.select(F.inline(F.array(*(cell(i, j) for i in range(len(columns)) for j in range(len(columns))))))


def corr_lower(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strictly below the diagonal."""
    return corr_matrix(df, columns).filter("i > j")


def season_premium(df: DataFrame, by: str, target: str) -> DataFrame:
    """Median, mean, deviation and count per group, and the premium over the cheapest median."""
    moments = df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.count(target).alias("count"))
    rounded = moments.join(group_medians(df, by, target), by).select(
        by, *(F.bround(c, 0).alias(c) for c in ("median", "mean", "std")), "count")
    # one row per group by now: the window sees the finished summary only
    lowest = F.min("median").over(Window.partitionBy())
    premium = F.bround(F.try_divide((F.col("median") - lowest) * 100, lowest), 1)
    return rounded.withColumn("premium_pct", premium).orderBy(F.desc("median"), by)
