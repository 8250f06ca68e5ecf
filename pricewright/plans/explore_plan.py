"""All exploratory tables of one feature table, lazily, by chart name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricewright.operators import explore
from pricewright.spec import TableSpec


def explore_run(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    target = spec.target
    trend = explore.monthly_trend(df, target)
    return {
        "hist_target": explore.histogram(df, target),
        "hist_log_target": explore.histogram(df, target, log=True),
        "kde_target": explore.density(df, target),
        "kde_log_target": explore.density(df, target, log=True),
        "skew": explore.skew_pair(df, target),
        "monthly_trend": trend,
        "peak_months": explore.peak_months(trend),
        "season_order": explore.median_order(df, spec.season, target),
        "box_season": explore.box_stats(df, spec.season, target),
        "season_premium": explore.season_premium(df, spec.season, target),
        "airline_summary": explore.group_summary(df, spec.carrier, target),
        "box_airline": explore.box_stats(df, spec.carrier, target),
        "top_routes_count": explore.top_by_count(df, "Route"),
        "top_routes_fare": explore.top_by_mean(df, "Route", target),
        "corr_lower": explore.corr_lower(df, (*spec.numeric, target)),
    }
