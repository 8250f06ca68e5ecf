"""Learners, tuning and artefacts on designs whose answer SQL can state.

One-hot of one categorical makes least squares and trees predict group means;
one scaled numeric makes ridge and lasso a formula; ridge on a one-hot column
has a closed form too. Every design uses the whole fare table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalog.base import SPEC, featured, raw, rounded
from catalog.evaluate import _errors
from fixtures.sql import bag_weight, bucket, query, r
from pricewright.functions.numeric import FOLD_STREAM, TEST_STREAM
from pricewright.operators import evaluate, features, models, tuning
from pricewright.plans.retrain_plan import retrain
from pricewright.plans.train_plan import encode_split, full_refit, train_all
from pricewright.sources import artifacts
from pricewright.sources.tables import null_tokens
from pricewright.staging import new_path, staged

CABIN = replace(SPEC, categorical=("Class",), numeric=())
AIRLINE = replace(SPEC, categorical=("Airline",), numeric=())
DURATION = replace(SPEC, categorical=(), numeric=("Duration_hrs",))
MONTH = replace(SPEC, categorical=(), numeric=("Month",))
PAIR = replace(SPEC, categorical=(), numeric=("Duration_hrs", "Month"))
JOURNEY = replace(SPEC, categorical=("Journey",), numeric=())
TWO = replace(SPEC, categorical=(), numeric=("Duration_hrs", "Weekday", "Constant"))
_ALPHAS = models.GRIDS["ridge"]["alpha"]


def design(spark, sf, spec):
    """(encoded rows with label, split and folds; fitted preprocessor)."""
    frame = featured(spark, sf).withColumn("Constant", F.lit(7.0)).withColumn(
        "Journey", F.concat("Route", F.lit(" "), "Stop_Type"))
    model = features.preprocess(frame.filter("NOT is_test"), spec)
    kept = ("rid", "label", "is_test", "fold", "Class", "Airline", "Duration_hrs", "Month")
    return staged(features.encode(frame, model, *kept), "design"), model


def train_rows(spark, sf, spec):
    encoded, model = design(spark, sf, spec)
    return encoded.filter("NOT is_test"), model


def _by_group(name, spec, by, params=None):
    """Fit on the training side, predict everything, one prediction per group."""
    def run(spark, sf):
        encoded, _ = design(spark, sf, spec)
        model = models.fit(name, params or {}, encoded.filter("NOT is_test"))
        return rounded(model.transform(encoded).groupBy(by).agg(
            F.min("prediction").alias("prediction"), F.max("prediction").alias("same")))
    return run


_BAGGED = {"n_estimators": 5, "max_depth": 1, "max_features": 0.5}
# Which of the two features (0 Duration_hrs, 1 Month) MLlib draws for the root of each tree at the spec's seed.
_DRAWN = (0, 0, 1, 0, 1)


def fit_forest_bagged(spark, sf):
    """Bootstrap samples and feature subsets on: trees of one split, each with its own weights and feature."""
    encoded, _ = design(spark, sf, PAIR)
    model = models.fit("forest", _BAGGED, encoded.filter("NOT is_test"), key="rid", seed=SPEC.seed)
    return rounded(model.transform(encoded).groupBy("Month", "Duration_hrs").agg(
        F.min("prediction").alias("prediction"), F.max("prediction").alias("same")))


def _fit_line(name, params):
    """Slope and intercept on one scaled numeric."""
    def run(spark, sf):
        train, _ = train_rows(spark, sf, DURATION)
        model = models.fit(name, params, train)
        return rounded(spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                             "slope double, intercept double"), 6)
    return run


def grid_search(spark, sf):
    train, _ = train_rows(spark, sf, DURATION)
    found = tuning.grid_search("ridge", {"alpha": _ALPHAS}, train, SPEC.folds)
    return rounded(found.table.select("candidate", "mean_train_r2", "mean_val_r2"), 6)


def grid_search_tree(spark, sf):
    """Depths are read off one fit per fold and leaf size."""
    train, _ = train_rows(spark, sf, MONTH)
    found = tuning.grid_search("tree", _SMALL_SPACE, train, SPEC.folds, key="rid")
    return rounded(found.table.select("candidate", "params", "mean_val_r2"), 6)


# A tree space whose scores SQL can state; the full one is models.SPACES.
_SMALL_SPACE = {"max_depth": [1, 2], "min_samples_leaf": [1, 2, 3]}
_SAMPLE = 4


def random_search(spark, sf):
    train, _ = train_rows(spark, sf, MONTH)
    found = tuning.random_search("tree", _SMALL_SPACE, train, SPEC.folds, _SAMPLE, SPEC.seed, key="rid")
    return rounded(found.table.select("candidate", "params", "mean_val_r2"), 6)


def train_val_gap(spark, sf):
    """A tree with three leaves, and least squares with a coefficient per journey, which learns by heart."""
    out = []
    for spec, name, params in ((CABIN, "tree", {"max_depth": 2}), (JOURNEY, "linear", {})):
        train, _ = train_rows(spark, sf, spec)
        found = tuning.search(name, [params], train, SPEC.folds)
        out.append(found.table.select(F.lit(spec.categorical[0]).alias("design"), "mean_train_r2", "mean_val_r2", "gap",
                                      "overfit"))
    return rounded(out[0].unionByName(out[1]), 6)


def cv_scores(spark, sf):
    train, _ = train_rows(spark, sf, CABIN)
    scores = tuning.cross_validate("linear", [{}], train, SPEC.folds)
    return rounded(scores.select("fold", F.col("val_r2").alias("r2")), 6)


def _learning(name, params):
    def run(spark, sf):
        train, _ = train_rows(spark, sf, CABIN)
        return rounded(tuning.learning_curve(name, params, train, "rid", SPEC.seed), 6)
    return run


def _airline_ridge(spark, sf):
    train, prep = train_rows(spark, sf, AIRLINE)
    return models.fit("ridge", {"alpha": 10.0}, train), features.feature_names(prep)


def feature_importance(spark, sf):
    model, names = _airline_ridge(spark, sf)
    return rounded(models.feature_importance(model, spark, names), 6)


def importance_share(spark, sf):
    model, names = _airline_ridge(spark, sf)
    return rounded(models.importance_share(models.feature_importance(model, spark, names, None)), 6)


def coef_compare(spark, sf):
    train, prep = train_rows(spark, sf, TWO)
    return rounded(models.coef_compare(
        models.fit("ridge", {"alpha": 10.0}, train), models.fit("lasso", {"alpha": 0.01}, train),
        spark, features.feature_names(prep)), 6)


def full(spark, sf):
    encoded, _ = design(spark, sf, CABIN)
    model = full_refit(encoded, "tree", {"max_depth": 2}, SPEC.seed)
    return rounded(model.transform(encoded).groupBy("Class").agg(F.min("prediction").alias("prediction")))


def _cabin_pipeline(spark, sf, everything=False):
    encoded, prep = design(spark, sf, CABIN)
    rows = encoded if everything else encoded.filter("NOT is_test")
    return PipelineModel(stages=[*prep.stages, models.fit("tree", {"max_depth": 2}, rows)])


def _predictions(model, spark, sf):
    return model.transform(featured(spark, sf)).groupBy("Class").agg(F.min("prediction").alias("prediction"))


def save_load_model(spark, sf):
    path = new_path(spark, "model")
    artifacts.save_model(_cabin_pipeline(spark, sf), path)
    return rounded(_predictions(artifacts.load_model(path), spark, sf))


def versioned_save(spark, sf):
    """Two versions, the second current, then the first again: what each would serve."""
    root = new_path(spark, "models")
    artifacts.save_version(_cabin_pipeline(spark, sf), root, "202601010000", spark)
    artifacts.save_version(_cabin_pipeline(spark, sf, everything=True), root, "202601020000", spark)
    current = _predictions(artifacts.load_version(root, spark), spark, sf).withColumn(
        "served", F.lit("current " + artifacts.current_version(root, spark)))
    artifacts.point_to(root, "202601010000", spark)
    back = _predictions(artifacts.load_version(root, spark), spark, sf).withColumn(
        "served", F.lit("rollback " + artifacts.current_version(root, spark)))
    return rounded(current.unionByName(back))


def train_models(spark, sf):
    """The seven learners on all features with fixed, moderate parameters."""
    derived = features.derive_features(featured(spark, sf).drop("label", "is_test", "fold"), SPEC)
    encoded, prep = encode_split(derived, SPEC, "rid")
    trained = train_all(encoded, prep, SPEC, "rid", params={
        "linear": {}, "ridge": {"alpha": 1.0}, "lasso": {"alpha": 1e-4}, "tree": {"max_depth": 8},
        "forest": {"n_estimators": 10, "max_depth": 6, "max_features": 0.5},
        "gbt_depth": {"n_estimators": 5, "learning_rate": 0.3, "max_depth": 4},
        "gbt_leaf": {"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 31, "min_child_samples": 20}})
    return evaluate.model_ranking(trained.metrics)


def retrain_flow(spark, sf):
    done = retrain(null_tokens(raw(spark, sf)), SPEC, new_path(spark, "retrain"), learner="tree",
                   params={"max_depth": 8}, version="202601010000")
    return done.metrics.withColumn("version", F.lit(done.version)) \
        .withColumn("residual_std", done.interval.agg(F.max("residual_std").alias("x")).scalar())


# A key that any engine reads off the cleaned columns.
_KEY = "CAST(floor(Base_Fare) AS BIGINT) * 1000 + Days_Before_Departure"


def retrain_flow_cabin(spark, sf):
    """The whole run on one categorical, whose metrics follow from group means of the training side."""
    done = retrain(null_tokens(raw(spark, sf)), CABIN, new_path(spark, "retrain"), learner="tree",
                   params={"max_depth": 2}, version="202601010000", key=F.expr(_KEY))
    return rounded(done.metrics.withColumn("version", F.lit(done.version))
                   .withColumn("residual_std", done.interval.agg(F.max("residual_std").alias("x")).scalar()), 4)


def train_models_cabin(spark, sf):
    """Search, fit, folds, test metrics and ranking of two learners that both come down to group means."""
    encoded, prep = design(spark, sf, CABIN)
    trained = train_all(encoded, prep, CABIN, "rid", learners=("linear", "tree"), spaces={},
                        grids={"tree": {"max_depth": [1, 2], "min_samples_leaf": [1, 5]}})
    ranked = evaluate.model_ranking(trained.metrics)
    return rounded(ranked.withColumn("max_depth", F.when(F.col("model") == "tree", trained.params["tree"]["max_depth"]))
                   .drop("train_seconds", "log_target"))


QUERIES = {
    "fit_linear": _by_group("linear", CABIN, "Class"),
    "fit_ridge": _fit_line("ridge", {"alpha": 1000.0}),
    "fit_lasso": _fit_line("lasso", {"alpha": 0.05}),
    "fit_tree": _by_group("tree", MONTH, "Month", {"max_depth": 1}),
    "fit_forest": _by_group("forest", MONTH, "Month", {"max_depth": 2, "n_estimators": 5, "bootstrap": False}),
    "fit_forest_bagged": fit_forest_bagged,
    "fit_gbt_depth": _by_group("gbt_depth", MONTH, "Month", {"max_depth": 1, "n_estimators": 2, "learning_rate": 0.3}),
    "fit_gbt_leaf": _by_group("gbt_leaf", MONTH, "Month", {"num_leaves": 2, "n_estimators": 3, "learning_rate": 0.5}),
    "grid_search": grid_search,
    "grid_search_tree": grid_search_tree,
    "random_search": random_search,
    "train_val_gap": train_val_gap,
    "cv_scores": cv_scores,
    "learning_curve": _learning("linear", {}),
    "learning_curve_tree": _learning("tree", {"max_depth": 2}),
    "feature_importance": feature_importance,
    "importance_share": importance_share,
    "coef_compare": coef_compare,
    "full_refit": full,
    "save_load_model": save_load_model,
    "versioned_save": versioned_save,
    "train_models": train_models,
    "train_models_cabin": train_models_cabin,
    "retrain_flow": retrain_flow,
    "retrain_flow_cabin": retrain_flow_cabin,
}

_MEANS = "SELECT Class, {p} FROM features {where} GROUP BY Class"
_TRAIN_MEANS = _MEANS.format(p=f"{r('avg(label)')} AS prediction, {r('avg(label)')} AS same", where="WHERE NOT is_test")
_TRAIN_ONLY = _MEANS.format(p=f"{r('avg(label)')} AS prediction", where="WHERE NOT is_test")

# z is the numeric scaled by the training side; t the training rows
_Z = """WITH t AS (SELECT fold, label AS y, (Duration_hrs - m) / s AS z FROM features,
  (SELECT avg(Duration_hrs) AS m, stddev_pop(Duration_hrs) AS s FROM features WHERE NOT is_test)
  WHERE NOT is_test)"""
_S = """SELECT count(*) AS n, avg(y) AS my, avg(z) AS mz, covar_pop(y, z) * count(*) AS syz,
  var_pop(z) * count(*) AS szz, var_pop(y) * count(*) AS syy FROM t"""


def _stump(name: str, rows: str, weight: str = "1") -> str:
    """Best split of (side, x, y) rows per side by squared error: ``name`` has side, cut and the means."""
    return f"""{name}_g AS (SELECT side, x, sum({weight}) AS n, sum({weight} * y) AS s FROM {rows} WHERE {weight} > 0 GROUP BY side, x),
      {name}_c AS (SELECT a.side, a.x AS cut, sum(b.n) FILTER (b.x <= a.x) AS nl, sum(b.s) FILTER (b.x <= a.x) AS sl,
          sum(b.n) FILTER (b.x > a.x) AS nr, sum(b.s) FILTER (b.x > a.x) AS sr
        FROM {name}_g a JOIN {name}_g b ON a.side = b.side GROUP BY a.side, a.x),
      {name} AS (SELECT side, cut, sl / nl AS l, sr / nr AS h FROM {name}_c WHERE nr > 0
        QUALIFY row_number() OVER (PARTITION BY side ORDER BY sl * sl / nl + sr * sr / nr DESC) = 1)"""


_MONTHS = """WITH t AS (SELECT 0 AS side, Month AS x, label AS y FROM features WHERE NOT is_test),
  m AS (SELECT DISTINCT Month FROM features)"""
_FIRST = f"{_MONTHS}, {_stump('s0', 't')}"


def _month_rows(value: str, tables: str) -> str:
    return f"SELECT Month, {r(value)} AS prediction, {r(value)} AS same FROM {tables}"


def _boosted(rounds: int, rate: float) -> str:
    """Stumps on twice the residuals, the first of weight one, as squared loss has it."""
    text, tables, before, now = _FIRST, "m, s0", "", "CASE WHEN {x} <= s0.cut THEN s0.l ELSE s0.h END"
    for k in range(1, rounds):
        text += (f", r{k} AS (SELECT 0 AS side, x, 2 * (y - ({now.format(x='x')})) AS y "
                 f"FROM t, {', '.join(f's{j}' for j in range(k))}), {_stump(f's{k}', f'r{k}')}")
        tables += f", s{k}"
        now += f" + {rate} * CASE WHEN {{x}} <= s{k}.cut THEN s{k}.l ELSE s{k}.h END"
    return f"{text} {_month_rows(now.format(x='Month'), tables)}"


_DEPTH_TWO = f"""{_FIRST}, u AS (SELECT CAST(x > cut AS INTEGER) AS side, x, y FROM t, s0), {_stump('s1', 'u')}
  {_month_rows('CASE WHEN s1.cut IS NULL THEN (CASE WHEN Month <= s0.cut THEN s0.l ELSE s0.h END) '
               'WHEN Month <= s1.cut THEN s1.l ELSE s1.h END',
               'm JOIN s0 ON true LEFT JOIN s1 ON s1.side = CAST(Month > s0.cut AS INTEGER)')}"""


def _bagged() -> str:
    """The mean of weighted stumps, one per tree and its drawn feature."""
    column = ("Duration_hrs", "Month")
    weights = ", ".join(f"{bag_weight('rid', t)} AS w{t}" for t in range(len(_DRAWN)))
    parts = ", ".join(f"x{t} AS (SELECT 0 AS side, {column[f]} AS x, y, w{t} FROM t), {_stump(f's{t}', f'x{t}', f'w{t}')}"
                      for t, f in enumerate(_DRAWN))
    mean = " + ".join(f"CASE WHEN {column[f]} <= s{t}.cut THEN s{t}.l ELSE s{t}.h END" for t, f in enumerate(_DRAWN))
    value = f"({mean}) / {len(_DRAWN)}"
    return f"""WITH t AS (SELECT rid, Month, Duration_hrs, label AS y, {weights} FROM features WHERE NOT is_test), {parts}
      SELECT Month, {r('Duration_hrs')} AS Duration_hrs, {r(value)} AS prediction, {r(value)} AS same
      FROM (SELECT DISTINCT Month, Duration_hrs FROM features), {', '.join(f's{t}' for t in range(len(_DRAWN)))}"""


def _grid() -> str:
    """Ridge on one numeric for every penalty and fold, from sums per side."""
    alphas = ", ".join(f"({i}, {a!r})" for i, a in enumerate(_ALPHAS))
    side = """SELECT k, count(*) AS n, avg(y) AS my, avg(z) AS mz, covar_pop(y, z) * count(*) AS syz,
      var_pop(z) * count(*) AS szz, var_pop(y) * count(*) AS syy FROM t, range(5) f(k) WHERE fold {op} k GROUP BY k"""
    r2 = ("1 - (s.syy - 2 * w * s.syz + w * w * s.szz + s.n * (s.my - b - w * s.mz) * (s.my - b - w * s.mz)) / s.syy")
    return f"""{_Z}, tr AS ({side.format(op='<>')}), va AS ({side.format(op='=')}),
      a(candidate, alpha) AS (VALUES {alphas}),
      m AS (SELECT candidate, k, syz / (szz + alpha) AS w, my - syz / (szz + alpha) * mz AS b FROM tr, a)
      SELECT CAST(candidate AS INTEGER) AS candidate, {r(f"avg({r2.replace('s.', 'tr.')})", 6)} AS mean_train_r2,
        {r(f"avg({r2.replace('s.', 'va.')})", 6)} AS mean_val_r2
      FROM m JOIN tr USING (k) JOIN va USING (k) GROUP BY candidate"""


# group means by Class fitted on the other folds, scored on both sides
_FOLD_R2 = """WITH t AS (SELECT fold, Class, label AS y FROM features WHERE NOT is_test),
  m AS (SELECT k, Class, avg(y) AS p FROM t, range(5) f(k) WHERE fold <> k GROUP BY k, Class),
  s AS (SELECT k, fold = k AS held_out, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2
        FROM t JOIN m USING (Class) GROUP BY k, fold = k)"""


_GAP = f"""SELECT '{{design}}' AS design,
        {r('avg(r2) FILTER (NOT held_out)', 6)} AS mean_train_r2, {r('avg(r2) FILTER (held_out)', 6)} AS mean_val_r2,
        {r('avg(r2) FILTER (NOT held_out) - avg(r2) FILTER (held_out)', 6)} AS gap,
        avg(r2) FILTER (NOT held_out) - avg(r2) FILTER (held_out) > 0.05 AS overfit FROM s"""

# least squares on a column per journey: their means, and the mean of those for one the other folds lack
_JOURNEY_R2 = """WITH t AS (SELECT fold, Route || ' ' || Stop_Type AS d, label AS y FROM features WHERE NOT is_test),
  m AS (SELECT k, d, avg(y) AS p FROM t, range(5) f(k) WHERE fold <> k GROUP BY k, d),
  b AS (SELECT k, avg(p) AS b FROM m GROUP BY k),
  s AS (SELECT k, fold = k AS held_out, 1 - avg((y - coalesce(p, b)) * (y - coalesce(p, b))) / var_pop(y) AS r2
        FROM t JOIN b ON true LEFT JOIN m USING (k, d) GROUP BY k, fold = k)"""


def _trees(candidates) -> str:
    """Depths one and two on every fold: splits found on the other folds, scored on this one."""
    rows = " UNION ALL ".join(f"SELECT {i} AS c, '{tuning._text(p)}' AS params, avg({'one' if p['max_depth'] == 1 else 'two'}) AS v FROM s"
                              for i, p in enumerate(candidates))
    score = "1 - avg((y - {p}) * (y - {p})) / var_pop(y)"
    return f"""WITH t AS (SELECT fold, Month AS x, label AS y FROM features WHERE NOT is_test),
      tr AS (SELECT k AS side, x, y FROM t, range(5) f(k) WHERE fold <> k), {_stump('d1', 'tr')},
      u AS (SELECT tr.side * 2 + CAST(x > cut AS INTEGER) AS side, x, y FROM tr JOIN d1 ON d1.side = tr.side),
      {_stump('d2', 'u')},
      p AS (SELECT fold, y, CASE WHEN x <= d1.cut THEN d1.l ELSE d1.h END AS one,
          CASE WHEN d2.cut IS NULL THEN (CASE WHEN x <= d1.cut THEN d1.l ELSE d1.h END)
               WHEN x <= d2.cut THEN d2.l ELSE d2.h END AS two
        FROM t JOIN d1 ON d1.side = fold LEFT JOIN d2 ON d2.side = fold * 2 + CAST(x > d1.cut AS INTEGER)),
      s AS (SELECT fold, {score.format(p='one')} AS one, {score.format(p='two')} AS two FROM p GROUP BY fold)
      SELECT CAST(c AS INTEGER) AS candidate, params, {r('v', 6)} AS mean_val_r2 FROM ({rows})"""


def _curve() -> str:
    sizes = ", ".join(f"({s!r}, {round(s * 1000)})" for s in tuning.SIZES)
    return f"""WITH t AS (SELECT {bucket('rid', 3, FOLD_STREAM)} AS part, size_rank, Class, label AS y
        FROM features WHERE NOT is_test),
      c(share, top) AS (VALUES {sizes}),
      u AS (SELECT share, top, k, part = k AS held_out, Class, y FROM t, c, range(3) f(k)
            WHERE part = k OR size_rank < top),
      m AS (SELECT share, k, Class, avg(y) AS p FROM u WHERE NOT held_out GROUP BY ALL),
      s AS (SELECT share, k, held_out, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2
            FROM u JOIN m USING (share, k, Class) GROUP BY ALL)
      SELECT CAST(share AS DOUBLE) AS share,
        {r('avg(r2) FILTER (NOT held_out)', 6)} AS train_mean, {r('stddev_pop(r2) FILTER (NOT held_out)', 6)} AS train_std,
        {r('avg(r2) FILTER (held_out)', 6)} AS val_mean, {r('stddev_pop(r2) FILTER (held_out)', 6)} AS val_std
      FROM s GROUP BY share"""


# ridge on the one-hot Airline column with a free intercept b
AIRLINE_RIDGE = """WITH g AS (SELECT Airline, count(*) AS n, avg(label) AS my, count(*) * 10.0 / (count(*) + 10.0) AS c
    FROM features WHERE NOT is_test GROUP BY Airline),
  i AS (SELECT sum(c * my) / sum(c) AS b FROM g),
  w AS (SELECT Airline, b, n * (my - b) / (n + 10.0) AS w FROM g, i)"""

_COEF = """WITH t AS (SELECT label AS y, (Duration_hrs - md) / sd AS x, (Weekday - mw) / sw AS v FROM features,
    (SELECT avg(Duration_hrs) AS md, stddev_pop(Duration_hrs) AS sd, avg(Weekday) AS mw,
      stddev_pop(Weekday) AS sw FROM features WHERE NOT is_test) WHERE NOT is_test),
  s AS (SELECT count(*) AS n, covar_pop(x, y) AS cx, covar_pop(v, y) AS cv, covar_pop(x, v) AS xv FROM t),
  w AS (SELECT (cx * (1 + 10.0 / n) - cv * xv) / ((1 + 10.0 / n) * (1 + 10.0 / n) - xv * xv) AS rx,
    (cv * (1 + 10.0 / n) - cx * xv) / ((1 + 10.0 / n) * (1 + 10.0 / n) - xv * xv) AS rv,
    sign(cx) * greatest(abs(cx) - 0.01, 0) AS lx,
    sign(cv - xv * sign(cx) * greatest(abs(cx) - 0.01, 0))
      * greatest(abs(cv - xv * sign(cx) * greatest(abs(cx) - 0.01, 0)) - 0.01, 0) AS lv FROM s),
  c AS (SELECT 'Duration_hrs' AS feature, rx AS ridge, lx AS lasso FROM w
        UNION ALL SELECT 'Weekday', rv, lv FROM w UNION ALL SELECT 'Constant', 0, 0)"""

_TEST_ERRORS = "p AS (SELECT y, e FROM t JOIN m USING (Class) WHERE is_test)"
_MEAN_BY_CLASS = "m AS (SELECT Class, avg(y) AS e FROM t WHERE NOT is_test GROUP BY Class)"

ORACLES = {
    "train_models_cabin": query("features", f"""SELECT * FROM ({_FOLD_R2},
      c AS (SELECT round_even(avg(r2), 4) AS cv_mean, round_even(stddev_pop(r2), 4) AS cv_std FROM s WHERE held_out),
      g AS (SELECT Class, avg(label) AS e FROM features WHERE NOT is_test GROUP BY Class),
      p AS (SELECT label AS y, e FROM features JOIN g USING (Class) WHERE is_test),
      x AS (SELECT {_errors('y', 'e')} FROM p)
      SELECT model, x.*, c.*, CAST(rank AS INTEGER) AS rank, CAST(depth AS INTEGER) AS max_depth
      FROM x, c, (VALUES ('linear', 1, NULL), ('tree', 2, 2)) v(model, rank, depth))"""),
    "retrain_flow_cabin": query("clean_features", f"""SELECT * FROM (
      WITH t AS (SELECT Class, ln(1 + Total_Fare) AS y, {bucket(_KEY, 10_000, TEST_STREAM)} < 2000 AS is_test
                 FROM clean_features), {_MEAN_BY_CLASS}, {_TEST_ERRORS}
      SELECT {_errors('y', 'e')}, '202601010000' AS version, {r('stddev_pop(exp(y) - exp(e))')} AS residual_std FROM p)"""),
    "fit_linear": query("features", _TRAIN_MEANS),
    "fit_ridge": query("features", f"""SELECT * FROM ({_Z} SELECT {r('syz / (szz + 1000)', 6)} AS slope,
      {r('my - mz * syz / (szz + 1000)', 6)} AS intercept FROM ({_S}))"""),
    "fit_lasso": query("features", f"""SELECT * FROM ({_Z}
      SELECT {r('w', 6)} AS slope, {r('my - w * mz', 6)} AS intercept
      FROM (SELECT my, mz, sign(syz) * greatest(abs(syz) / n - 0.05, 0) / (szz / n) AS w FROM ({_S})))"""),
    "fit_tree": query("features", f"""SELECT * FROM ({_FIRST}
      {_month_rows('CASE WHEN Month <= cut THEN l ELSE h END', 'm, s0')})"""),
    "fit_forest": query("features", f"SELECT * FROM ({_DEPTH_TWO})"),
    "fit_forest_bagged": query("features", f"SELECT * FROM ({_bagged()})"),
    "fit_gbt_depth": query("features", f"SELECT * FROM ({_boosted(2, 0.3)})"),
    "fit_gbt_leaf": query("features", f"SELECT * FROM ({_boosted(3, 0.5)})"),
    "grid_search": query("features", f"SELECT * FROM ({_grid()})"),
    "grid_search_tree": query("features", f"SELECT * FROM ({_trees(tuning.grid(_SMALL_SPACE))})"),
    "random_search": query("features", f"SELECT * FROM ({_trees(tuning.sampled(_SMALL_SPACE, _SAMPLE, SPEC.seed))})"),
    "train_val_gap": query("features", f"""SELECT * FROM ({_FOLD_R2} {_GAP.format(design='Class')})
      UNION ALL SELECT * FROM ({_JOURNEY_R2} {_GAP.format(design='Journey')})"""),
    "cv_scores": query("features", f"""SELECT * FROM ({_FOLD_R2}
      SELECT CAST(k AS INTEGER) AS fold, {r('r2', 6)} AS r2 FROM s WHERE held_out)"""),
    "learning_curve": query("features", f"SELECT * FROM ({_curve()})"),
    "learning_curve_tree": query("features", f"SELECT * FROM ({_curve()})"),
    "feature_importance": query("features", f"""SELECT * FROM ({AIRLINE_RIDGE}
      SELECT 'Airline_' || Airline AS feature, {r('abs(w)', 6)} AS importance FROM w ORDER BY abs(w) DESC LIMIT 15)"""),
    "importance_share": query("features", f"""SELECT * FROM ({AIRLINE_RIDGE}
      SELECT 'Airline_' || Airline AS feature, {r('abs(w)', 6)} AS importance,
        round_even(abs(w) / sum(abs(w)) OVER () * 100, 2) AS importance_pct,
        CAST(row_number() OVER (ORDER BY abs(w) DESC, Airline) AS INTEGER) AS rank FROM w
      QUALIFY row_number() OVER (ORDER BY abs(w) DESC, Airline) <= 10)"""),
    "coef_compare": query("features", f"""SELECT * FROM ({_COEF}
      SELECT feature, {r('ridge', 6)} AS ridge, {r('lasso', 6)} AS lasso,
        CAST(row_number() OVER (ORDER BY abs(ridge) DESC, feature) AS INTEGER) AS ridge_rank,
        CAST(row_number() OVER (ORDER BY abs(lasso) DESC, feature) AS INTEGER) AS lasso_rank,
        count(*) FILTER (lasso = 0) OVER () AS n_zero_lasso FROM c)"""),
    "full_refit": query("features", _MEANS.format(p=f"{r('avg(label)')} AS prediction", where="")),
    "save_load_model": query("features", _TRAIN_ONLY),
    "versioned_save": query("features", f"""
      SELECT Class, {r('avg(label)')} AS prediction, 'current 202601020000' AS served FROM features GROUP BY Class
      UNION ALL SELECT Class, {r('avg(label)')}, 'rollback 202601010000' FROM features WHERE NOT is_test GROUP BY Class"""),
}
