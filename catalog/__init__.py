"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from __future__ import annotations

from functools import wraps
from importlib import import_module

from pricewright.session import input_bytes, tuned

_SECTIONS = ("sources", "profiling", "cleaning", "features", "explore", "models", "evaluate", "scoring")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for section in _SECTIONS:
        out |= getattr(import_module(f"catalog.{section}"), attribute)
    return out


def _in_tuned_session(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(tuned(spark, input_bytes(spark, sf_dir)), sf_dir)
    return run


def queries() -> dict:
    return {name: _in_tuned_session(query) for name, query in _merged("QUERIES").items()}


def oracles() -> dict:
    return _merged("ORACLES")
