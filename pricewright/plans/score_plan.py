"""The scoring job: served model, its own interval and metrics, requests in, bounded prices out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricewright.operators import clean, score
from pricewright.sources import artifacts
from pricewright.spec import TableSpec


def score_requests(raw: DataFrame, spec: TableSpec, root: str, version: str | None = None) -> DataFrame:
    """Requests as they arrive, typed, dated, priced and bounded.

    Requests without a departure leave their lead time from today; those without
    another numeric input come back without a price and with the input's name.
    """
    model, interval, metrics = artifacts.load_serving(root, raw.sparkSession, version)
    typed = clean.normalise_labels(clean.coerce_types(clean.rename_columns(raw, spec), spec), spec)
    dated = score.default_departure(typed, spec)
    return score.score_interval(score.score_batch(dated, model, spec), interval, metrics)


def score_run(raw: DataFrame, spec: TableSpec, root: str, version: str | None = None) -> str:
    """Write the scored requests under the version that priced them."""
    chosen = version or artifacts.current_version(root, raw.sparkSession)
    path = f"{root}/scored/v={chosen}-{artifacts.version_stamp(raw.sparkSession)}"
    score_requests(raw, spec, root, chosen).write.parquet(path)
    return path
