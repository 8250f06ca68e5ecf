"""Inputs that used to be lost, misread or fatal."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pricewright.functions.numeric import r_squared
from pricewright.operators import clean, explore, features, models, score, tuning
from pricewright.sources import tables
from pricewright.spec import AIRFARES


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_headers_in_another_order_are_refused(spark, tmp_path):
    path = write(tmp_path / "a", x="a,b\n1,2\n", y="b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.scan_csv(spark, path).collect()


@pytest.mark.parametrize("row", ["1,2,3", "1"])
def test_ragged_rows_are_refused(spark, tmp_path, row):
    path = write(tmp_path / "a", x=f"a,b\n1,2\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.scan_csv(spark, path).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "a", x='a,b\n1,"two\nlines"\n')
    assert tables.scan_csv(spark, path, multi_line=True).collect()[0]["b"] == "two\nlines"


def test_time_layouts_and_their_gate(spark):
    rows = [("2024-01-02 10:30",), ("01/02/2024 10:30",), ("2024/01/02 10:30",), ("Jan 2 2024 10:30",), (None,)]
    df = spark.createDataFrame(rows, "Date string")
    typed = clean.coerce_types(df, replace(AIRFARES, contract={"Date": AIRFARES.contract["Date"]}))
    assert {str(r[0]) for r in typed.collect()} == {"2024-01-02 10:30:00", "None"}
    bad = spark.createDataFrame([("2 I 24",), ("3 I 24",), ("2024-01-02",)], "Date string")
    with pytest.raises(ValueError, match="2 of 3"):
        clean.require_times(bad, AIRFARES)


def test_nothing_configured_or_constant(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert clean.range_report(df, AIRFARES).count() == 0 and clean.relabelled_counts(df, AIRFARES).count() == 0
    curve = explore.density(df, "v", points=5).collect()
    assert [(r["x"], r["density"]) for r in curve] == [(5.0, None)] * 5


def test_missing_numerics_stop_nothing(spark):
    spec = replace(AIRFARES, categorical=(), numeric=("Duration_hrs",))
    frame = spark.createDataFrame([(float(k), float(k)) for k in range(1, 20)], "Duration_hrs double, label double")
    prep = features.preprocess(frame, spec)
    model = models.fit("linear", {}, prep.transform(frame))
    prep.stages.append(model)
    asked = spark.createDataFrame([(1, 3.0, "Direct", "A", "B", None), (2, None, "Direct", "A", "B", None)],
                                  "rid int, Duration_hrs double, Stop_Raw string, Source string, Destination string, "
                                  "Date timestamp_ntz")
    got = {r["rid"]: r for r in score.score_batch(asked, prep, spec).collect()}
    assert got[1]["predicted_fare"] > 0 and got[1]["missing_inputs"] is None
    assert got[2]["predicted_fare"] is None and got[2]["missing_inputs"] == "Duration_hrs"


def test_empty_folds_and_wide_vectors(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["v"], outputCol="features").transform(
        spark.range(60).select((F.col("id") * 1.0).alias("v"), (F.col("id") * 2.0 + 1).alias("label"),
                               (F.col("id") % 3).cast("int").alias("fold")))
    assert tuning.cross_validate("ridge", [{"alpha": 0.1}], df, 4).where("val_r2 > 0.9").count() == 3
    narrow = {r["fold"]: r["val_r2"] for r in tuning.cross_validate("ridge", [{"alpha": 1e-6}], df, 3).collect()}
    fitted = {}
    for k in range(3):
        model = models.fit("ridge", {"alpha": 1e-6}, df.where(F.col("fold") != k))
        fitted[k] = model.transform(df.where(F.col("fold") == k)).agg(
            r_squared(F.col("label"), F.col("prediction"))).first()[0]
    assert narrow == pytest.approx(fitted, abs=1e-6)
    # wider vectors than a driver can hold the products of are refused, not searched by another solver
    monkeypatch.setattr(tuning, "MAX_WIDTH", 1)
    with pytest.raises(ValueError, match="do not fit a driver"):
        tuning.cross_validate("ridge", [{"alpha": 1e-6}], df, 3)
