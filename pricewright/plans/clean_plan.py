"""The cleaning run: raw table in, clean table and its reports out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pricewright.operators import clean, impute
from pricewright.spec import TableSpec
from pricewright.staging import staged, staged_pieces


@dataclass(frozen=True)
class Cleaned:
    frame: DataFrame
    #: lazy; nothing is computed for a report nobody writes
    reports: dict[str, DataFrame]


def clean_run(raw: DataFrame, spec: TableSpec, *, reports: bool = True) -> Cleaned:
    """Rename, validate, coerce, bound, audit, relabel, deduplicate, impute, re-price.

    The deduplicated table is written, so that the only full shuffle runs once
    whatever number of statistics the imputation needs. With ``reports`` the
    typed table is written too: the reports then read single columns of it
    instead of parsing the raw text again.
    """
    renamed = clean.require_times(clean.validate_schema(clean.rename_columns(raw, spec), spec), spec)
    typed = clean.coerce_types(renamed, spec)
    if reports:
        typed = staged(typed, "typed")
    in_range = clean.range_filter(typed, spec)
    # the audit precedes relabelling on purpose: it reports the raw labels
    # a written table is cheap to read again, so only digests and rows that may repeat are shuffled
    whole = clean.normalise_labels(in_range, spec)
    pieces = clean.distinct_pieces(whole, clean.distinct_by_digest if reports else clean.drop_duplicates)
    unique = staged_pieces(pieces, "unique", whole)
    frame = clean.min_base_filter(impute.impute_config(unique, spec), spec)
    return Cleaned(frame, {} if not reports else {
        "validation_dtypes": clean.dtype_report(renamed, typed, spec),
        "validation_ranges": clean.range_report(typed, spec),
        "validation_categoricals": clean.category_audit(in_range, spec),
        "validation_missing": impute.missing_audit(unique, spec),
    })


def clean_pipeline(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Just the clean table."""
    return clean_run(raw, spec, reports=False).frame
