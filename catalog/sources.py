"""Scans, gates and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SPEC, dated, fares, in_range, raw, rounded, typed_stage, unique
from fixtures.sql import COLUMNS, query, r
from pricewright.operators import clean, profile
from pricewright.sources import tables
from pricewright.staging import new_path

_DATED = ", ".join("strftime(Date, '%Y-%m-%d %H:%M:%S') AS Date" if c == "Date" else c for c in COLUMNS)


def scan_csv(spark, sf):
    path = new_path(spark, "csv")
    (raw(spark, sf).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    scanned = tables.scan_csv(spark, path)
    return dated(clean.coerce_types(clean.rename_columns(scanned, SPEC), SPEC))


def write_reports(spark, sf):
    folder = new_path(spark, "reports")
    paths = tables.write_reports({
        "validation_ranges": clean.range_report(typed_stage(spark, sf), SPEC),
        "validation_categoricals": clean.category_audit(in_range(spark, sf), SPEC)}, folder)
    back = tables.scan_csv(spark, paths[1])
    return back.withColumn("count", F.col("count").cast("bigint")).withColumn("pct", F.col("pct").cast("double"))


def stage_handoff(spark, sf):
    kept = fares(spark, sf).select("rid", "Season", "Duration_hrs", "Total_Fare")
    return tables.hand_off(kept, new_path(spark, "handoff"))


def run_log(spark, sf):
    path = new_path(spark, "runlog")
    tables.log_run(path, "run-1", "load", profile.profile_shape(raw(spark, sf)))
    tables.log_run(path, "run-1", "clean", profile.profile_shape(unique(spark, sf)))
    tables.log_run(path, "run-1", "total", rounded(clean.total_summary(fares(spark, sf), SPEC)))
    return tables.read_run_log(spark, path)


def _careless_folder(spark, sf):
    """Fares as lines of CSV files: half of them with the columns the other way round, some with a cell too many or too few."""
    folder = new_path(spark, "careless")
    rows = fares(spark, sf)
    for side, names in enumerate((_CARELESS, _CARELESS[::-1])):
        own = rows.where(F.pmod("rid", F.lit(2)) == side)
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
        line = (F.when(F.pmod("rid", F.lit(31)) == 5, F.concat_ws(",", *cells[:-1]))
                .when(F.pmod("rid", F.lit(37)) == 3, F.concat_ws(",", *cells, F.lit("extra")))
                .when(F.pmod("rid", F.lit(41)) == 2, F.concat(F.lit('"'), F.concat_ws(",", *cells)))
                .otherwise(F.concat_ws(",", *cells)))
        (own.select(line.alias(",".join(names))).write.mode("append").option("header", True)
         # a separator and a quote no line holds: each line is written as it is
         .option("sep", "\u0001").option("quote", "\u0002").csv(folder))
    return folder


_CARELESS = ("rid", "Airline", "Class", "Season")


def scan_quarantine(spark, sf):
    """Refused rows per reason, and the accepted ones with a digest of each column."""
    folder, refused = _careless_folder(spark, sf), new_path(spark, "refused")
    taken = tables.scan_quarantined(spark, folder, refused, limit=0.2)
    accepted = taken.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("rows"),
                         F.sum(F.col("rid").cast("bigint") % 1_000_003).alias("rids"),
                         F.count_distinct("Airline").alias("airlines"), F.min("Class").alias("class"),
                         F.max("Season").alias("season"))
    return accepted.unionByName(tables.refused_counts(spark.read.parquet(refused)), allowMissingColumns=True)


QUERIES = {
    "scan_quarantine": scan_quarantine,
    "scan_csv": scan_csv,
    "header_gate": lambda s, d: tables.header_gate(raw(s, d), SPEC.raw_required + ("Gate",)),
    "min_fare_gate": lambda s, d: tables.min_value_gate(raw(s, d), "Base Fare (BDT)", SPEC.min_base),
    "write_reports": write_reports,
    "stage_handoff": stage_handoff,
    "run_log": run_log,
}

_AUDIT = """
  SELECT "column", unexpected_val, count(*) AS count,
    round_even(100.0 * count(*) / (SELECT count(*) FROM in_range), 2) AS pct, expected_set
  FROM (SELECT 'Stop_Raw' AS "column", Stop_Raw AS unexpected_val, 'Direct|1 Stop|2 Stops' AS expected_set
          FROM in_range WHERE Stop_Raw NOT IN ('Direct', '1 Stop', '2 Stops')
        UNION ALL
        SELECT 'Class', Class, 'Economy|Business|First' FROM in_range
          WHERE Class NOT IN ('Economy', 'Business', 'First'))
  GROUP BY "column", unexpected_val, expected_set"""

ORACLES = {
    "scan_quarantine": query("fares", """SELECT * FROM (
      WITH c AS (SELECT *, CASE WHEN rid % 31 = 5 THEN 'too few cells' WHEN rid % 37 = 3 THEN 'too many cells'
                   WHEN rid % 41 = 2 THEN 'open quote' ELSE 'accepted' END AS reason FROM fares)
      SELECT reason, count(*) AS rows, CAST(sum(rid % 1000003) AS BIGINT) AS rids, count(DISTINCT Airline) AS airlines,
        min(Class) AS class, max(Season) AS season FROM c WHERE reason = 'accepted' GROUP BY reason
      UNION ALL SELECT reason, count(*), NULL, NULL, NULL, NULL FROM c WHERE reason <> 'accepted' GROUP BY reason)"""),
    "scan_csv": query("typed", f"SELECT {_DATED} FROM typed"),
    "header_gate": query("dirty", " UNION ALL ".join(
        [f"""SELECT '{c}' AS "column", true AS present, count({SPEC.rename.get(c, c)}) AS rows FROM dirty"""
         for c in SPEC.raw_required] + ["SELECT 'Gate', false, 0"])),
    "min_fare_gate": query("typed", "SELECT count(*) AS valid_rows FROM typed WHERE Base_Fare >= 500"),
    "write_reports": query("in_range", _AUDIT),
    "stage_handoff": query("fares", "SELECT rid, Season, Duration_hrs, Total_Fare FROM fares"),
    "run_log": query("uniq fares", f"""
      SELECT 'run-1' AS run_id, stage, metric, CAST(value AS DOUBLE) AS value FROM (
        SELECT 'load' AS stage, 'rows' AS metric, count(*) AS value FROM dirty
        UNION ALL SELECT 'load', 'columns', 17
        UNION ALL SELECT 'clean', 'rows', count(*) FROM uniq
        UNION ALL SELECT 'clean', 'columns', 17
        UNION ALL SELECT 'total', 'min_total', {r('min(Total_Fare)')} FROM fares
        UNION ALL SELECT 'total', 'max_total', {r('max(Total_Fare)')} FROM fares
        UNION ALL SELECT 'total', 'mean_total', {r('avg(Total_Fare)')} FROM fares)"""),
}
