"""The whole job: raw table in, reports, best model and its interval out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from pricewright.operators import evaluate, features, impute, models, profile, tuning
from pricewright.plans.clean_plan import clean_run
from pricewright.plans.explore_plan import explore_run
from pricewright.plans.train_plan import Trained, encode_split, full_refit, train_all
from pricewright.sources import artifacts, tables
from pricewright.spec import TableSpec
from pricewright.staging import Stages, source_fingerprint, staged


@dataclass(frozen=True)
class Finished:
    best: str
    version: str
    model: PipelineModel
    trained: Trained
    report_paths: list[str]


def evaluation_run(trained: Trained, encoded: DataFrame, spec: TableSpec, key: str) -> dict[str, DataFrame]:
    """Comparison, fold report, diagnostics of the best model, ridge against lasso."""
    spark = encoded.sparkSession
    best = trained.best()
    names = features.feature_names(trained.preprocessor)
    judged = trained.predictions.filter(F.col("model") == best)
    report = evaluate.cv_report(trained.scores, spec.folds)
    importances = models.feature_importance(trained.models[best], spark, names, top=None)
    out = {
        "model_metrics": evaluate.model_ranking(trained.metrics),
        "model_cv_comparison": evaluate.cv_summary(trained.metrics, spec.folds),
        "cv_report_full": report,
        "cv_unstable": evaluate.cv_unstable(report),
        "residual_table": evaluate.residual_table(judged, log=spec.log_target),
        "pred_vs_actual": evaluate.pred_vs_actual(judged, key, log=spec.log_target),
        "residual_hist": evaluate.residual_hist(judged, log=spec.log_target),
        "feature_importance": importances.limit(15),
        "importance_share": models.importance_share(importances),
        "learning_curve": tuning.learning_curve(
            best, trained.params[best], encoded.filter("NOT is_test"), key, spec.seed),
    }
    out |= {f"search_{name}": table for name, table in trained.searches.items()}
    if {"ridge", "lasso"} <= set(trained.models):
        out["ridge_vs_lasso"] = models.coef_compare(trained.models["ridge"], trained.models["lasso"], spark, names)
    return out


def full_run(raw: DataFrame, spec: TableSpec, root: str, *, explore: bool = True,
             version: str | None = None, resume: str | None = None, **training: Mapping) -> Finished:
    """Clean, explore, tune and compare all learners, refit the best on all rows, save it.

    With a ``resume`` folder the cleaned, derived and encoded tables and the preprocessor are kept there under a
    fingerprint of the input files and the spec: a run that died is started again and goes on behind the last
    of them, a changed input or spec starts over.
    ``training`` goes to ``train_all``: learners, grids, spaces, n_iter, params.
    """
    spark = raw.sparkSession
    cleaned = cache(lambda: clean_run(raw, spec))
    stages = Stages(spark, resume, source_fingerprint(raw, spec, raw.schema.simpleString())) if resume else None
    keep = stages.table if stages else (lambda label, build: staged(build(), label))
    complete = keep("clean", lambda: impute.assert_no_nulls(staged(cleaned().frame, "clean")))
    derived = keep("features", lambda: features.row_key(features.derive_features(complete, spec)))
    profiled = {"profile_columns": profile.profile_columns(raw, approximate=True)}
    paths = tables.write_reports(profiled | cleaned().reports, f"{root}/reports") if not (
        stages and stages.done("reports")) else []
    if stages:
        stages.mark("reports")
    if explore:
        paths += tables.write_reports(explore_run(derived, spec), f"{root}/explore")

    encoded, preprocessor = encode_split(derived, spec, "row_key", stages)
    trained = train_all(encoded, preprocessor, spec, "row_key", **training)
    paths += tables.write_reports(evaluation_run(trained, encoded, spec, "row_key"), f"{root}/reports")

    best = trained.best()
    judged = trained.predictions.filter(F.col("model") == best)
    served = PipelineModel(stages=[*preprocessor.stages,
                                   full_refit(encoded, best, trained.params[best], spec.seed, "row_key")])
    version = version or artifacts.version_stamp(spark)
    artifacts.save_version(served, root, version, spark, learner=best, params=trained.params[best],
                           interval=evaluate.residual_std(judged, log=spec.log_target),
                           metrics=evaluate.serving_metrics(trained.metrics))
    return Finished(best, version, served, trained, paths)
