"""The fixture views, computed by Spark from the given tables and staged once per session."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.functions.numeric import FOLD_STREAM, TEST_STREAM, bucket
from pricewright.session import input_bytes
from pricewright.spec import AIRFARES
from pricewright.staging import new_path, slices, spread, write_pieces

_PATHS: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, name


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The stage table of what ``build`` gives, a frame or frames one after the other, written at the first call."""
    key = _key(spark, sf_dir, name)
    if key not in _PATHS:
        path = new_path(spark, name)
        built = build()
        write_pieces([built] if isinstance(built, DataFrame) else built, path)
        _PATHS[key] = path
    return spark.read.parquet(_PATHS[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(column: str, cases: dict[str, str], otherwise: str | None = None) -> Column:
    chosen = F
    for value, label in cases.items():
        chosen = chosen.when(F.col(column) == value, label)
    return chosen.otherwise(otherwise) if otherwise else chosen


def _build_fares(spark: SparkSession, sf_dir: str, own=lambda table, key: table) -> DataFrame:
    """The fares of the line items and orders that ``own`` leaves."""
    t = lambda name: table(spark, sf_dir, name)
    cn = t("nation").select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("Source"))
    sn = t("nation").select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("Destination"))
    # what an order brings along is joined before it meets the line items, which are dealt by order and, if the parts
    # are too many to send, by part; nations come last, as keys are shorter than names, and a supplier's size is known
    # as long as nothing is joined to it
    orders = (own(t("orders"), "o_orderkey").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey"))
    joined = (
        # a small table can be a single row group, which one task would read alone
        spread(own(t("lineitem"), "l_orderkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(F.broadcast(cn), F.col("c_nationkey") == F.col("cn_key"))
        .join(F.broadcast(sn), F.col("s_nationkey") == F.col("sn_key")))
    lead = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    cabin = F.when(F.col("Class") == "First Class", 3.0).when(F.col("Class") == "Business", 2.0).otherwise(1.0)
    return (
        joined
        .withColumn("rid", F.col("l_orderkey") * 1000003 + F.col("l_partkey") * 101
                    + F.col("l_suppkey") * 7 + F.col("l_linenumber"))
        .withColumn("Duration_hrs", F.col("l_quantity") * 0.3 + 0.2)
        .withColumn("Class", _choice("c_mktsegment", {"FURNITURE": "First Class", "BUILDING": "Business"},
                                     "Economy"))
        .withColumn("Base_Fare", (F.lit(20000.0) + F.col("l_extendedprice") * 0.25) * cabin
                    * (F.lit(1.0) + F.col("Duration_hrs") * 0.05))
        .withColumn("Tax_Surcharge", F.col("Base_Fare") * F.col("l_tax"))
        .select(
            "rid", F.col("p_brand").alias("Airline"), "Source",
            F.concat(F.lit("City "), "Source").alias("Source_Name"), "Destination",
            F.concat(F.lit("City "), "Destination").alias("Destination_Name"),
            F.col("l_shipdate").alias("Date"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("Arrival_Date"),
            "Duration_hrs",
            _choice("l_returnflag", {"N": "Direct", "A": "1 Stop", "R": "2 Stops"}).alias("Stop_Raw"),
            F.col("p_type").alias("Aircraft_Type"), "Class",
            _choice("o_orderstatus", {"F": "Online Website", "O": "Travel Agency", "P": "Direct Booking"})
            .alias("Booking_Source"),
            "Base_Fare", "Tax_Surcharge",
            (F.col("Base_Fare") + F.col("Tax_Surcharge")).alias("Total_Fare"),
            _choice("o_orderpriority", {"1-URGENT": "Eid", "2-HIGH": "Hajj", "3-MEDIUM": "Winter Holidays"},
                    "Regular").alias("Season"),
            (F.pmod(lead, F.lit(90)) + 1).cast("bigint").alias("Days_Before_Departure")))


def fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One priced ticket per line item, clean apart from the 'First Class' label."""
    return _once(spark, sf_dir, "fares", lambda: _fare_pieces(spark, sf_dir))


def _fare_pieces(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The fares by slices of the orders, for stages written one slice after the other."""
    if _key(spark, sf_dir, "fares") in _PATHS:
        yield fares(spark, sf_dir)
        return
    n = slices(input_bytes(spark, f"{sf_dir}/lineitem.parquet"))
    for i in range(n):
        yield _build_fares(spark, sf_dir, (
            lambda table, key: table.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)) if n > 1 else lambda table, key: table)


def _build_dirty(clean: DataFrame) -> DataFrame:
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    rows = clean.withColumn("copy", F.explode(F.when(F.pmod("rid", F.lit(43)) == 11, twice).otherwise(once)))
    hit = lambda m, r: F.pmod(F.col("rid"), F.lit(m)) == r
    text = lambda c: F.col(c).cast("string")
    null = F.lit(None).cast("string")
    token = F.element_at(F.array(*map(F.lit, ("NA", "N/A", "null", "", "NaN"))),
                         (F.expr("pmod(rid div 10, 5)") + 1).cast("int"))
    damaged = rows.select(
        F.when(hit(89, 1), null).otherwise(F.col("Airline")).alias("Airline"),
        "Source",
        F.when(hit(53, 9), null).otherwise(F.col("Source_Name")).alias("Source_Name"),
        "Destination", "Destination_Name",
        F.when(hit(79, 3), "bad").otherwise(F.date_format("Date", "yyyy-MM-dd")).alias("Date"),
        "Arrival_Date",
        F.when(hit(73, 4), "x").otherwise(text("Duration_hrs")).alias("Duration_hrs"),
        F.when(hit(61, 7), "3 Stops").when(hit(59, 8), " direct ").otherwise(F.col("Stop_Raw")).alias("Stop_Raw"),
        F.when(hit(83, 2), null).otherwise(F.col("Aircraft_Type")).alias("Aircraft_Type"),
        "Class", "Booking_Source",
        F.when(hit(71, 5), "100").when(hit(67, 6), "900000").otherwise(text("Base_Fare")).alias("Base_Fare"),
        F.when(hit(97, 0), null).when(hit(47, 10), token).otherwise(text("Tax_Surcharge"))
        .alias("Tax_Surcharge"),
        F.when(hit(41, 12), (F.col("Total_Fare") + 1000).cast("string")).otherwise(text("Total_Fare"))
        .alias("Total_Fare"),
        "Season", text("Days_Before_Departure").alias("Days_Before_Departure"))
    raw_names = {v: k for k, v in AIRFARES.rename.items()}
    return damaged.withColumnsRenamed(raw_names)


def raw_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17 raw text columns with deterministic damage, as a careless CSV would hold them."""
    return _once(spark, sf_dir, "raw_fares", lambda: map(_build_dirty, _fare_pieces(spark, sf_dir)))


def once_from_raw(spark: SparkSession, sf_dir: str, name: str, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage table derived from the raw rows in one pass over them; neither they nor the fares are written for it."""
    return _once(spark, sf_dir, name, lambda: (derive(_build_dirty(piece)) for piece in _fare_pieces(spark, sf_dir)))


def with_split(df: DataFrame) -> DataFrame:
    """``is_test`` and ``fold`` by row key, as the operators assign them."""
    return (df.withColumn("is_test", bucket("rid", 10_000, AIRFARES.seed, TEST_STREAM) < 2_000)
              .withColumn("fold", bucket("rid", 5, AIRFARES.seed, FOLD_STREAM)))
