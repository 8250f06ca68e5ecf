"""Exploratory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SPEC, featured, raw, rounded
from catalog.features import SKEW
from fixtures.sql import query, r
from pricewright.operators import explore, features
from pricewright.plans.clean_plan import clean_pipeline
from pricewright.sources.tables import null_tokens

_CORR = (*SPEC.numeric, SPEC.target)


def season_premium_clean(spark, sf):
    clean = clean_pipeline(null_tokens(raw(spark, sf)), SPEC)
    return explore.season_premium(features.derive_features(clean, SPEC), "Season", SPEC.target)


def _rounded_density(spark, sf, digits, log):
    curve = explore.density(featured(spark, sf), SPEC.target, log=log)
    return rounded(curve.withColumn("x", F.round("x", 4)), digits)


QUERIES = {
    "hist_target": lambda s, d: rounded(explore.histogram(featured(s, d), SPEC.target)),
    "hist_log_target": lambda s, d: rounded(explore.histogram(featured(s, d), SPEC.target, log=True)),
    "kde_target": lambda s, d: _rounded_density(s, d, 10, log=False),
    "kde_log_target": lambda s, d: _rounded_density(s, d, 6, log=True),
    "skew_pair": lambda s, d: rounded(explore.skew_pair(featured(s, d), SPEC.target)),
    "monthly_trend": lambda s, d: rounded(explore.monthly_trend(featured(s, d), SPEC.target)),
    "peak_months": lambda s, d: rounded(explore.peak_months(
        explore.monthly_trend(featured(s, d), SPEC.target))),
    "season_order": lambda s, d: rounded(explore.median_order(featured(s, d), "Season", SPEC.target)),
    "box_season": lambda s, d: rounded(explore.box_stats(featured(s, d), "Season", SPEC.target)),
    "airline_summary": lambda s, d: rounded(explore.group_summary(featured(s, d), "Airline", SPEC.target)),
    "box_airline": lambda s, d: rounded(explore.box_stats(featured(s, d), "Airline", SPEC.target)),
    "top_routes_count": lambda s, d: explore.top_by_count(featured(s, d), "Route"),
    "top_routes_fare": lambda s, d: rounded(explore.top_by_mean(featured(s, d), "Route", SPEC.target)),
    "corr_matrix": lambda s, d: rounded(explore.corr_matrix(featured(s, d), _CORR), 6),
    "corr_lower": lambda s, d: rounded(explore.corr_lower(featured(s, d), _CORR), 6),
    "season_premium": lambda s, d: explore.season_premium(featured(s, d), "Season", SPEC.target),
    "season_premium_clean": season_premium_clean,
}


def hist_sql(values: str, digits: int = 4) -> str:
    return f"""SELECT bin, {r('lo + bin * ((hi - lo) / 60)', digits)} AS bin_start,
        {r('lo + (bin + 1) * ((hi - lo) / 60)', digits)} AS bin_end, coalesce(n, 0) AS count
      FROM (SELECT min(v) AS lo, max(v) AS hi FROM ({values})), range(60) b(bin)
      LEFT JOIN (SELECT least(CAST(floor((v - lo) / ((hi - lo) / 60)) AS BIGINT), 59) AS hit, count(*) AS n
        FROM ({values}), (SELECT min(v) AS lo, max(v) AS hi FROM ({values})) GROUP BY hit) ON hit = bin"""


def _kde(values: str, digits: int) -> str:
    return f"""WITH v AS ({values}),
      s AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM v),
      g AS (SELECT p AS point, lo + p * ((hi - lo) / 199) AS x, h, n FROM s, range(200) t(p))
      SELECT point, {r('x', 4)} AS x,
        {r('sum(exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (n * h * sqrt(2 * pi()))', digits)} AS density
      FROM g, v GROUP BY point, x, h, n"""


def _box(by: str) -> str:
    return f"""SELECT {by}, {r('q1')} AS q1, {r('med')} AS median, {r('q3')} AS q3,
      {r('min(v) FILTER (v >= q1 - f AND v <= q3 + f)')} AS whisker_lo,
      {r('max(v) FILTER (v >= q1 - f AND v <= q3 + f)')} AS whisker_hi,
      count(*) FILTER (NOT (v >= q1 - f AND v <= q3 + f)) AS n_outliers, count(*) AS n
      FROM (SELECT {by}, Total_Fare AS v FROM features) JOIN (
        SELECT {by}, quantile_cont(Total_Fare, 0.25) AS q1, quantile_cont(Total_Fare, 0.5) AS med,
          quantile_cont(Total_Fare, 0.75) AS q3,
          (quantile_cont(Total_Fare, 0.75) - quantile_cont(Total_Fare, 0.25)) * 1.5 AS f
        FROM features GROUP BY {by}) USING ({by}) GROUP BY {by}, q1, med, q3"""


def _corr(lower: bool) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS i, {j} AS j, '{x}' AS x, '{y}' AS y, {r(f'corr({x}, {y})', 6)} AS corr FROM features"""
        for i, x in enumerate(_CORR) for j, y in enumerate(_CORR) if not lower or i > j)


_TREND = f"""SELECT Month, {r('avg(Total_Fare)')} AS mean, {r('stddev_samp(Total_Fare)')} AS std,
  {r('avg(Total_Fare) - stddev_samp(Total_Fare)')} AS band_lo,
  {r('avg(Total_Fare) + stddev_samp(Total_Fare)')} AS band_hi FROM features GROUP BY Month"""


def _premium(view: str) -> str:
    return f"""SELECT Season, median, mean, std, count,
      round_even((median - min(median) OVER ()) * 100 / min(median) OVER (), 1) AS premium_pct
      FROM (SELECT Season, round_even(median(Total_Fare), 0) AS median, round_even(avg(Total_Fare), 0) AS mean,
        round_even(stddev_samp(Total_Fare), 0) AS std, count(*) AS count FROM {view} GROUP BY Season)"""


_RAW, _LOG = "SELECT Total_Fare AS v FROM features", "SELECT label AS v FROM features"

ORACLES = {
    "hist_target": query("features", hist_sql(_RAW)),
    "hist_log_target": query("features", hist_sql(_LOG)),
    "kde_target": query("features", "SELECT * FROM (" + _kde(_RAW, 10) + ")"),
    "kde_log_target": query("features", "SELECT * FROM (" + _kde(_LOG, 6) + ")"),
    "skew_pair": query("features", f"""SELECT {r(SKEW.format(v='Total_Fare'))} AS skew_raw,
      {r(SKEW.format(v='label'))} AS skew_log FROM features"""),
    "monthly_trend": query("features", _TREND),
    "peak_months": query("features", f"""SELECT Month, CASE Month WHEN 4 THEN 'Eid-ul-Fitr' ELSE 'Eid-ul-Adha' END
      AS label, mean FROM ({_TREND}) WHERE Month IN (4, 7)"""),
    "season_order": query("features", f"""SELECT Season, {r('median(Total_Fare)')} AS median,
      format('{{:,}}', CAST(round_even(median(Total_Fare), 0) AS BIGINT)) AS label FROM features GROUP BY Season"""),
    "box_season": query("features", _box("Season")),
    "airline_summary": query("features", f"""SELECT Airline, {r('avg(Total_Fare)')} AS mean_fare, count(*) AS count
      FROM features GROUP BY Airline"""),
    "box_airline": query("features", _box("Airline")),
    "top_routes_count": query("features", """SELECT Route, count(*) AS count FROM features GROUP BY Route
      ORDER BY count DESC, Route LIMIT 10"""),
    "top_routes_fare": query("features", f"""SELECT Route, {r('avg(Total_Fare)')} AS avg_fare FROM features
      GROUP BY Route ORDER BY avg(Total_Fare) DESC, Route LIMIT 5"""),
    "corr_matrix": query("features", _corr(False)),
    "corr_lower": query("features", _corr(True)),
    "season_premium": query("features", _premium("features")),
    "season_premium_clean": query("clean", _premium("clean")),
}
