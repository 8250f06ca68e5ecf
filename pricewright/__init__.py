"""Tabular pricing analytics on Spark: profile, clean, encode, model and score."""

from pricewright.spec import AIRFARES, TableSpec

__all__ = ["AIRFARES", "TableSpec"]
