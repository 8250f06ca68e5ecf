from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pricewright.operators import clean, impute, profile
from pricewright.plans.clean_plan import clean_pipeline, clean_run
from pricewright.sources.tables import null_tokens
from pricewright.spec import AIRFARES, TableSpec

SPEC = TableSpec(contract={"a": ("double", "first"), "b": ("bigint", "second"), "d": ("timestamp_ntz", "when"),
                           "s": ("string", "label")},
                 bounds={"a": (0, 10), "b": (0, 5)}, allowed={"s": ("x", "y"), "d": None},
                 label_fixes={"s": {"why": "y"}})


def test_range_check_keeps_missing_and_counts_what_is_left(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 9), (float("nan"), 2), (11.0, 9), (-1.0, 1), (5.0, None)],
                               "a double, b long")
    typed = clean.coerce_types(df, SPEC)
    assert sorted(clean.range_filter(typed, SPEC).toPandas()["b"].dropna()) == [1, 2]
    assert clean.range_filter(typed, SPEC).count() == 3
    report = {r["column"]: r.asDict() for r in clean.range_report(typed, SPEC).collect()}
    assert (report["a"]["n_below"], report["a"]["n_above"], report["a"]["pct_removed"]) == (1, 1, 33.333)
    # the row already removed by ``a`` does not count again
    assert (report["b"]["n_above"], report["b"]["n_removed"], report["b"]["pct_removed"]) == (1, 1, 25.0)


def test_range_report_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b long")
    assert [r["pct_removed"] for r in clean.range_report(empty, SPEC).collect()] == [None, None]


def test_coercion_turns_bad_text_into_null(spark):
    df = spark.createDataFrame([("1.5", "7", "2024-02-30", "q"), ("x", "7.5", "2024-02-28 10:00:00", None)],
                               "a string, b string, d string, s string")
    typed = clean.coerce_types(df, SPEC)
    assert dict(typed.dtypes) == {"a": "double", "b": "double", "d": "timestamp_ntz", "s": "string"}
    rows = typed.collect()
    assert rows[0]["a"] == 1.5 and rows[1]["a"] is None and rows[0]["d"] is None
    assert rows[1]["d"].hour == 10 and rows[1]["b"] == 7.5 and rows[1]["s"] is None


def test_dtype_report_names_missing_and_compares_exactly(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "b int, d string")
    report = {r["column"]: r for r in clean.dtype_report(df, clean.coerce_types(df, SPEC), SPEC).collect()}
    assert report["a"]["status"] == "SKIP" and report["a"]["actual"] == "MISSING"
    assert report["b"]["status"] == "FIXED" and report["d"]["status"] == "FIXED"


def test_schema_error_names_the_column(spark):
    with pytest.raises(ValueError, match="a \\(first\\)"):
        clean.validate_schema(spark.createDataFrame([(1,)], "b int"), SPEC)


def test_audit_sees_labels_before_they_are_repaired(spark):
    df = spark.createDataFrame([("x",), ("why",), ("why",), (None,)], "s string")
    row = clean.category_audit(df, SPEC).first()
    assert (row["unexpected_val"], row["count"], row["pct"]) == ("why", 2, 50.0)
    assert clean.category_audit(clean.normalise_labels(df, SPEC), SPEC).count() == 0
    assert clean.relabelled_counts(df, SPEC).first()["n_changed"] == 2


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    assert clean.drop_duplicates(df).count() == 2
    assert profile.duplicate_count(df).first()["duplicates"] == 2
    assert profile.duplicate_count(df.filter("a > 9")).first()["duplicates"] == 0


def test_one_row_repeated_for_a_third_of_the_table(spark):
    df = spark.range(30_000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("a"),
                                    F.lit("x").alias("b"))
    assert clean.drop_duplicates(df).count() == 20_001


def raw_row(**changes):
    row = {"Airline": "A", "Source": "S", "Destination": "D", "Departure Date & Time": "2024-05-06 10:00:00",
           "Duration (hrs)": "2.5", "Stopovers": "Direct", "Aircraft Type": "T", "Class": "Economy",
           "Booking Source": "B", "Base Fare (BDT)": "1000", "Tax & Surcharge (BDT)": "100",
           "Total Fare (BDT)": "1100", "Seasonality": "Regular", "Days Before Departure": "10"}
    return row | changes


def raw_table(spark, rows):
    columns = list(raw_row())
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schema)


def test_clean_run_end_to_end(spark):
    raw = raw_table(spark, [
        raw_row(), raw_row(), raw_row(Airline="NA", Stopovers="1 Stop"),
        raw_row(**{"Base Fare (BDT)": "100"}), raw_row(**{"Departure Date & Time": "bad"}),
        raw_row(**{"Tax & Surcharge (BDT)": "oops", "Class": "First Class"}),
        raw_row(**{"Total Fare (BDT)": "5000", "Stopovers": "2 Stops"})])
    done = clean_run(null_tokens(raw), AIRFARES)
    rows = done.frame.collect()
    assert len(rows) == 4
    assert {r["Total_Fare"] for r in rows} == {1100.0}
    assert {r["Class"] for r in rows} == {"Economy", "First"}
    assert dict(done.frame.dtypes)["Days_Before_Departure"] == "bigint"
    assert {r["column"] for r in impute.remaining_nulls(done.frame).filter("null_count > 0").collect()} == set()
    assert done.reports["validation_categoricals"].first()["unexpected_val"] == "First Class"
    assert clean_pipeline(null_tokens(raw), AIRFARES).count() == 4


def test_cleaning_a_clean_table_changes_nothing(spark):
    raw = raw_table(spark, [raw_row(Airline=a, **{"Base Fare (BDT)": str(b)}) for a, b in
                            (("A", 900), ("B", 800), ("C", 700))])
    once = clean_pipeline(raw, AIRFARES)
    twice = clean_pipeline(once, AIRFARES)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_missing_feature_columns_are_tolerated(spark):
    spec = replace(AIRFARES, bounds={**AIRFARES.bounds, "Absent": (0, 1)})
    raw = raw_table(spark, [raw_row()])
    assert clean_pipeline(raw, spec).count() == 1


def test_operators_work_on_another_table(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    spec = TableSpec(contract={"value": ("double", "amount"), "event_type": ("string", "kind")},
                     bounds={"value": (1, 50)}, allowed={"event_type": ("click", "view")},
                     imputation={"value": "median"}, event_time="ts")
    assert profile.profile_columns(events).count() == len(events.columns)
    kept = clean.range_filter(clean.coerce_types(events, spec), spec)
    assert 0 < kept.count() < events.count()
    assert clean.category_audit(events, spec).count() > 0
    holes = events.withColumn("value", F.when(F.col("event_id") % 10 != 0, F.col("value")))
    filled = impute.impute_config(holes, spec)
    assert filled.filter("value IS NULL").count() == 0


def test_duplicates_by_digest_are_those_by_value(spark):
    rows = [(1, None, "a", 0.0), (1, "a", None, 0.0), (1, None, "a", -0.0), (2, "x", "y", float("nan")),
            (2, "x", "y", float("nan")), (3, None, None, None), (3, None, None, None), (4, "p", "q", 1.0)]
    df = spark.createDataFrame(rows * 2 + [(k, "u", str(k), 1.0) for k in range(10, 400)],
                               "id int, `a b` string, c string, v double").repartition(5)
    ours, theirs = clean.drop_duplicates_by_digest(df), df.dropDuplicates()
    assert ours.columns == df.columns and ours.count() == theirs.count() == 395
    assert ours.exceptAll(theirs).count() == 0
    assert clean.duplicate_count_by_digest(df).first()["duplicates"] == profile.duplicate_count(df).first()["duplicates"] == 11
    assert clean.drop_duplicates_by_digest(df.limit(0)).count() == 0
    assert clean.duplicate_count_by_digest(df.limit(0)).first()["duplicates"] == 0
