"""Sources, artefacts, evaluation tables and whole runs."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalog import base
from pricewright.operators import evaluate, features, models, score
from pricewright.plans.retrain_plan import retrain
from pricewright.plans.score_plan import score_requests
from pricewright.plans.train_plan import encode_split, train_all
from pricewright.sources import artifacts, tables
from pricewright.spec import AIRFARES
from pricewright.staging import in_parallel
from pricewright.streaming.score_stream import csv_requests, follow_stream, request_stream, score_stream

SF = "/root/testdata/sf0.001"
SMALL = replace(AIRFARES, categorical=("Class", "Season"), numeric=("Duration_hrs",))


def test_csv_tokens_quotes_and_missing_path(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,"b ""x""",c\nNA,null,1\n"",  keep ,NaN\n"q, r",N/A,2\n')
    rows = tables.scan_csv(spark, str(path)).collect()
    assert rows[0].asDict() == {"a": None, 'b "x"': None, "c": "1"}
    assert rows[1].asDict() == {"a": None, 'b "x"': "  keep ", "c": None}
    assert rows[2]["a"] == "q, r"
    with pytest.raises(FileNotFoundError, match="get the data"):
        tables.scan_csv(spark, str(tmp_path / "none.csv"), hint="get the data first")


def test_refused_rows_are_set_aside_and_columns_read_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('x,"y, z",w\n1,one,NA\n2,two\n3,three,c,d\n4,"fo""ur",\n5,"open,e\n')
    (folder / "b.csv").write_text('w,x\nf,6\n\n,7\n')
    refused = str(tmp_path / "refused")
    got = tables.scan_quarantined(spark, str(folder), refused, limit=0.5)
    assert {tuple(r[c] for c in ("x", "y, z", "w")) for r in got.collect()} == {
        ("1", "one", None), ("4", 'fo"ur', None), ("6", None, "f"), ("7", None, None)}
    bad = spark.read.parquet(refused)
    assert {(r["reason"], r["raw"]) for r in bad.collect()} == {
        ("too few cells", "2,two"), ("too many cells", "3,three,c,d"), ("open quote", '5,"open,e')}
    assert all(r["file"].endswith("a.csv") for r in bad.collect())
    with pytest.raises(tables.TooManyRefused, match="3 of 7"):
        tables.scan_quarantined(spark, str(folder), refused, limit=0.1)
    assert spark.read.parquet(refused).count() == 3
    with pytest.raises(FileNotFoundError, match="no data"):
        tables.scan_quarantined(spark, str(tmp_path / "none"), refused)


def test_one_of_two_writers_of_a_version_wins(spark, tmp_path):
    frame = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0)], "v double, label double")
    prep = features.preprocess(frame, replace(AIRFARES, categorical=(), numeric=("v",)))
    encoded, root = prep.transform(frame), str(tmp_path / "models")
    pipelines = [PipelineModel(stages=[*prep.stages, models.fit("ridge", {"alpha": a}, encoded)]) for a in (0.001, 1e6)]

    def save(which):
        try:
            artifacts.save_version(pipelines[which], root, "202601010000", spark, learner=f"writer {which}")
            return which
        except FileExistsError:
            return None

    won = [w for w in in_parallel(spark, [lambda: save(0), lambda: save(1)], 2) if w is not None]
    assert len(won) == 1 and artifacts.current_learner(root, spark)[0] == f"writer {won[0]}"
    served = artifacts.load_version(root, spark).transform(frame).agg(F.max("prediction") - F.min("prediction")).first()[0]
    assert (served > 1.9) == (won[0] == 0)
    # a writer that died after its claim leaves the old version current
    artifacts.claim(f"{root}/claims/202601020000", spark)
    with pytest.raises(FileExistsError):
        artifacts.save_version(pipelines[0], root, "202601020000", spark)
    assert artifacts.current_version(root, spark) == "202601010000"
    assert not (tmp_path / "models" / "v=202601020000").exists()


def test_gates(spark):
    df = spark.createDataFrame([("499.9",), ("x",), (None,)], "`Base Fare (BDT)` string")
    with pytest.raises(ValueError, match="Airline"):
        tables.require_header(df, AIRFARES.raw_required)
    with pytest.raises(ValueError, match=">= 500"):
        tables.require_min_value(df, "Base Fare (BDT)", 500)
    assert tables.require_min_value(df, "Base Fare (BDT)", 400) == 1


def test_versions_and_rollback(spark, tmp_path):
    frame = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0)], "v double, label double")
    spec = replace(AIRFARES, categorical=(), numeric=("v",))
    prep = features.preprocess(frame, spec)
    encoded = prep.transform(frame)
    root = str(tmp_path / "models")
    assert artifacts.current_version(root, spark) is None
    with pytest.raises(FileNotFoundError):
        artifacts.load_version(root, spark)
    for version, alpha in (("202601010000", 0.001), ("202601020000", 1e6)):
        artifacts.save_version(PipelineModel(stages=[*prep.stages, models.fit("ridge", {"alpha": alpha}, encoded)]),
                               root, version, spark)
    spread = lambda: artifacts.load_version(root, spark).transform(frame).agg(
        (F.max("prediction") - F.min("prediction")).alias("s")).first()["s"]
    assert spread() < 0.01
    artifacts.point_to(root, "202601010000", spark)
    assert spread() > 1.9
    with pytest.raises(FileNotFoundError, match="209901010000"):
        artifacts.point_to(root, "209901010000", spark)
    assert len(artifacts.version_stamp(spark)) == 14
    with pytest.raises(FileExistsError):
        artifacts.save_version(prep, root, "202601010000", spark)


def test_interval_store(spark, tmp_path):
    path = str(tmp_path / "interval")
    assert artifacts.read_interval(spark, path) is None
    artifacts.write_interval(spark.createDataFrame([(12.5,)], "residual_std double"), path)
    assert artifacts.read_interval(spark, path).first()["residual_std"] == 12.5


def one_row(spark, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))


@pytest.mark.parametrize("std,mae,lower,upper", [
    (100.0, 30.0, 0.0, 246.0), (0.0, 30.0, 20.0, 80.0), (None, 30.0, 20.0, 80.0), (None, None, None, None)])
def test_interval_falls_back_and_is_clamped(spark, std, mae, lower, upper):
    scored = one_row(spark, predicted_fare=50.0)
    row = score.score_interval(scored, one_row(spark, residual_std=std), one_row(spark, mae=mae)).first()
    assert (row["lower"], row["upper"]) == (lower, upper)


def test_interval_without_stored_tables(spark):
    assert score.score_interval(one_row(spark, predicted_fare=50.0)).first()["upper"] is None


def test_ranking_ties(spark):
    rows = [("c", 0.9, 0.01, 5.0, 1.0), ("b", 0.9, 0.01, 5.0, 1.0), ("d", 0.9, 0.01, 4.0, 1.0),
            ("a", 0.9, 0.02, 1.0, 1.0), ("e", 0.95, 0.5, 9.0, 2.0)]
    metrics = spark.createDataFrame(rows, "model string, cv_mean double, cv_std double, rmse double, mae double")
    assert [r["model"] for r in evaluate.model_ranking(metrics).collect()] == ["e", "d", "b", "c", "a"]
    assert evaluate.serving_metrics(metrics).first().asDict() == {"model": "e", "r2": 0.95, "mae": 2.0, "rmse": 9.0}


def test_cv_report_by_hand(spark):
    rows = [("m", i, r) for i, r in enumerate((0.90, 0.91, 0.89, 0.92, 0.88))] + [("u", i, i / 10) for i in range(5)]
    report = {r["model"]: r for r in evaluate.cv_report(
        spark.createDataFrame(rows, "model string, fold int, r2 double"), 5).collect()}
    m = report["m"]
    # population deviation sqrt(0.0002); half width 2.776 * sd / sqrt(5)
    assert (m["mean"], m["std"], m["range"], m["stable"]) == (0.9, 0.0141, 0.04, True)
    assert (m["ci_lower"], m["ci_upper"], m["fold_4"]) == (0.8824, 0.9176, 0.92)
    assert not report["u"]["stable"]


def test_metrics_by_hand(spark):
    import math
    rows = [(math.log1p(a), math.log1p(p)) for a, p in ((100.0, 110.0), (200.0, 180.0), (300.0, 300.0))]
    df = spark.createDataFrame(rows, f"{evaluate.ACTUAL} double, {evaluate.PREDICTED} double")
    row = evaluate.eval_metrics(df).first()
    assert (row["mae"], row["rmse"], row["r2_currency"]) == (10.0, 13.0, 0.975)


@pytest.fixture(scope="module")
def pipeline(spark):
    derived = features.derive_features(base.fares(spark, SF), SMALL)
    encoded, prep = encode_split(derived, SMALL, "rid")
    return PipelineModel(stages=[*prep.stages, models.fit("ridge", {"alpha": 1.0}, encoded.filter("NOT is_test"))])


REQUEST = ("rid", "Class", "Season", "Source", "Destination", "Stop_Raw", "Duration_hrs", "Date")


def test_stream_goes_on_where_it_stopped_and_equals_batch(spark, pipeline, tmp_path):
    requests = base.fares(spark, SF).select(*REQUEST)
    arriving, target, progress = (str(tmp_path / n) for n in ("arriving", "scored", "progress"))

    def run():
        stream = request_stream(spark, arriving, requests.schema)
        score_stream(stream, pipeline, SMALL, target, progress).awaitTermination()
        return spark.read.parquet(target)

    first = requests.filter("rid % 2 = 0")
    first.write.parquet(arriving)
    assert run().count() == first.count()
    requests.filter("rid % 2 <> 0").write.mode("append").parquet(arriving)
    scored = run()
    batch = score.score_batch(requests, pipeline, SMALL)
    assert scored.count() == batch.count()
    # a few keys repeat: compare as bags
    assert scored.exceptAll(batch).count() == 0 and batch.exceptAll(scored).count() == 0


def test_save_and_load_keep_predictions(spark, pipeline, tmp_path):
    requests = base.fares(spark, SF).select(*REQUEST)
    artifacts.save_model(pipeline, str(tmp_path / "m"))
    loaded = artifacts.load_model(str(tmp_path / "m"))
    a, b = score.score_batch(requests, pipeline, SMALL), score.score_batch(requests, loaded, SMALL)
    assert a.exceptAll(b).count() == 0


def test_predictions_do_not_depend_on_partitioning(spark, pipeline):
    requests = base.fares(spark, SF).select(*REQUEST)
    a = score.score_batch(requests.repartition(3), pipeline, SMALL)
    b = score.score_batch(requests.repartition(11), pipeline, SMALL)
    assert a.exceptAll(b).count() == 0


def test_training_run_compares_all_learners(spark):
    derived = features.derive_features(base.fares(spark, SF), SMALL)
    encoded, prep = encode_split(derived, SMALL, "rid")
    small = {"n_estimators": 2, "max_depth": 2}
    trained = train_all(
        encoded, prep, SMALL, "rid", n_iter=2,
        grids={"ridge": {"alpha": [0.1, 10.0]}, "lasso": {"alpha": [1e-4, 0.1]}, "tree": {"max_depth": [2, 5]}},
        spaces={"forest": {"n_estimators": [2], "max_depth": [2, 5]}},
        params={"gbt_depth": small, "gbt_leaf": {"n_estimators": 2, "num_leaves": 4}})
    ranked = evaluate.model_ranking(trained.metrics).collect()
    assert {r["model"] for r in ranked} == set(models.NAMES)
    assert ranked[0]["cv_mean"] > 0.7 and ranked[0]["r2_log"] > 0.7
    assert trained.scores.count() == 35
    pipeline = trained.pipeline(trained.best())
    assert score.score_batch(base.fares(spark, SF).select(*REQUEST), pipeline, SMALL).filter("predicted_fare > 0").count() > 0
    assert evaluate.cv_summary(trained.metrics, 5).count() == 7


def test_retraining_judges_on_unseen_rows(spark, tmp_path):
    raw = tables.null_tokens(base.raw(spark, SF))
    root = str(tmp_path / "run")
    with pytest.raises(FileNotFoundError, match="training job"):
        retrain(raw, SMALL, root)
    done = retrain(raw, SMALL, root, learner="tree", params={"max_depth": 4}, version="202601010000")
    row = done.metrics.first()
    assert 0.5 < row["r2_log"] < 1 and row["mae"] < row["rmse"]
    assert done.interval.first()["residual_std"] > 0
    assert artifacts.current_version(root, spark) == "202601010000"
    log = {(r["stage"], r["metric"]): r["value"] for r in tables.read_run_log(spark, f"{root}/run_log").collect()}
    assert log["encode", "rows"] > log["encode", "test_rows"] > 0
    assert log["evaluate", "r2_log"] == row["r2_log"]
    # the next run refits the same learner
    assert artifacts.current_learner(root, spark) == ("tree", {"max_depth": 4})
    again = retrain(raw, SMALL, root, version="202601020000")
    assert again.metrics.first() == row and artifacts.current_version(root, spark) == "202601020000"


def test_departure_defaults_to_today_plus_lead_time(spark):
    requests = spark.createDataFrame([(None, 14), (dt.datetime(2024, 3, 1), 5)], "Date timestamp_ntz, days int")
    rows = score.default_departure(requests, AIRFARES, "days", today=dt.date(2024, 2, 20)).collect()
    assert [r["Date"] for r in rows] == [dt.datetime(2024, 3, 5), dt.datetime(2024, 3, 1)]


def test_shared_folder_comes_from_the_session(spark):
    from pricewright.staging import new_path, shared_dir
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x").startswith(shared_dir(spark))


def test_calendar_value(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29),)], "Date timestamp_ntz") \
        .select("Date", F.lit("Direct").alias("Stop_Raw"), F.lit("A").alias("Source"), F.lit("B").alias("Destination"))
    assert features.calendar_range(features.derive_features(df, AIRFARES)).first().asDict() == {
        "min_month": 2, "max_month": 2, "min_weekday": 3, "max_weekday": 3}


def test_full_run_writes_reports_and_a_served_model(spark, tmp_path):
    raw = tables.null_tokens(base.raw(spark, SF))
    root = str(tmp_path / "full")
    from pricewright.plans.full_run import full_run
    done = full_run(raw, SMALL, root, version="202601010000", learners=("ridge", "lasso", "tree"), n_iter=2,
                    grids={"ridge": {"alpha": [0.1, 10.0]}, "lasso": {"alpha": [1e-4, 0.1]},
                           "tree": {"max_depth": [2, 4]}})
    assert done.best in ("ridge", "lasso", "tree")
    names = {p.rsplit("/", 1)[1] for p in done.report_paths}
    assert {"validation_dtypes", "validation_ranges", "validation_categoricals", "validation_missing",
            "hist_target", "box_airline", "model_metrics", "cv_report_full", "learning_curve", "ridge_vs_lasso"} <= names
    for path in done.report_paths:
        assert spark.read.csv(path, header=True).columns or path.endswith("cv_unstable")
    model, interval, metrics = artifacts.load_serving(root, spark)
    assert metrics.first()["mae"] > 0 and "profile_columns" in names
    requests = base.fares(spark, SF).select(*REQUEST)
    scored = score.score_interval(score.score_batch(requests, model, SMALL), interval, metrics)
    assert scored.filter("lower < predicted_fare AND predicted_fare < upper").count() == requests.count()


def test_raw_target_keeps_one_scale(spark):
    spec = replace(SMALL, log_target=False)
    derived = features.derive_features(base.fares(spark, SF), spec)
    encoded, prep = encode_split(derived, spec, "rid")
    trained = train_all(encoded, prep, spec, "rid", learners=("ridge",), params={"ridge": {"alpha": 1.0}})
    row = trained.metrics.first()
    assert row["r2_log"] == row["r2_currency"] > 0.5 and not row["log_target"]
    scored = score.score_batch(base.fares(spark, SF).select(*REQUEST), trained.pipeline("ridge"), spec)
    assert 10_000 < scored.agg(F.avg("predicted_fare")).first()[0] < 200_000


def test_a_run_that_died_goes_on_behind_its_last_stage(spark, tmp_path, monkeypatch):
    from pricewright.plans import full_run as plan
    source, root, kept = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "stages")
    base.raw(spark, SF).write.option("header", True).option("escape", '"').csv(source)
    training = dict(learners=("ridge",), params={"ridge": {"alpha": 1.0}}, explore=False, resume=kept)
    steps = []

    def watched(name, real):
        def run(*a, **k):
            steps.append(name)
            return real(*a, **k)
        monkeypatch.setattr(plan, name, run)
    watched("clean_run", plan.clean_run)
    real = plan.encode_split

    def dies(*a, **k):
        raise RuntimeError("killed")
    monkeypatch.setattr(plan, "encode_split", dies)
    with pytest.raises(RuntimeError, match="killed"):
        plan.full_run(tables.scan_csv(spark, source), SMALL, root, **training)
    assert steps == ["clean_run"]
    monkeypatch.setattr(plan, "encode_split", real)
    done = plan.full_run(tables.scan_csv(spark, source), SMALL, root, version="202601010000", **training)
    assert steps == ["clean_run"] and done.best == "ridge"
    # the encoded table and the preprocessor are there now, too
    monkeypatch.setattr(features, "preprocess", dies)
    again = plan.full_run(tables.scan_csv(spark, source), SMALL, root, version="202601020000", **training)
    assert again.trained.metrics.drop("train_seconds").collect() == done.trained.metrics.drop("train_seconds").collect()
    # another input or another spec starts over
    base.raw(spark, SF).limit(50).write.mode("append").option("header", True).option("escape", '"').csv(source)
    with pytest.raises(RuntimeError, match="killed"):
        plan.full_run(tables.scan_csv(spark, source), SMALL, root, version="202601030000", **training)
    with pytest.raises(RuntimeError, match="killed"):
        plan.full_run(tables.scan_csv(spark, source), replace(SMALL, seed=7), root, version="202601040000", **training)
    assert steps == ["clean_run"] * 3
    with pytest.raises(ValueError, match="read from files"):
        plan.full_run(spark.range(3).toDF("a"), SMALL, root, **training)


def test_the_stream_follows_the_served_version(spark, pipeline, tmp_path):
    requests = base.fares(spark, SF).select(*REQUEST).withColumn("Days_Before_Departure", F.lit(5))
    root, arriving, target, progress = (str(tmp_path / n) for n in ("models", "arriving", "followed", "progress"))
    doubled = PipelineModel(stages=[*pipeline.stages[:-1], models.fit(
        "ridge", {"alpha": 1e7}, PipelineModel(stages=pipeline.stages[:-1]).transform(
            features.log_target(features.derive_features(base.fares(spark, SF), SMALL), SMALL)))])
    text = requests.select(*(F.col(c).cast("string").alias(c) for c in requests.columns))

    def arrive(rows):
        rows.coalesce(1).write.mode("append").option("header", True).csv(arriving)
        follow_stream(csv_requests(spark, arriving), SMALL, root, target, progress).awaitTermination()
        return spark.read.parquet(f"{target}/scored")

    artifacts.save_version(pipeline, root, "1", spark)
    first = text.where("rid % 3 = 0")
    assert {r["version"] for r in arrive(first).select("version").distinct().collect()} == {"1"}
    artifacts.save_version(doubled, root, "2", spark)
    second = text.where("rid % 3 = 1").withColumn("Duration_hrs", F.when(F.col("rid").cast("long") % 2 == 0, F.col("Duration_hrs")))
    scored = arrive(second)
    counts = {r["version"]: r["count"] for r in scored.groupBy("version").count().collect()}
    refused = spark.read.parquet(f"{target}/refused")
    assert counts["1"] == first.count() and counts["2"] + refused.count() == second.count()
    assert {r["missing_inputs"] for r in refused.select("missing_inputs").distinct().collect()} == {"Duration_hrs"}
    batch = score_requests(first, SMALL, root, "1").agg(F.sum("predicted_fare")).first()[0]
    assert abs(scored.where("version = '1'").agg(F.sum("predicted_fare")).first()[0] - batch) < 1e-3
    # the last batch is run again after a lost commit: no row is added
    before = scored.count()
    commits = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for file in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        file.unlink(missing_ok=True)
    follow_stream(csv_requests(spark, arriving), SMALL, root, target, progress).awaitTermination()
    assert spark.read.parquet(f"{target}/scored").count() == before
