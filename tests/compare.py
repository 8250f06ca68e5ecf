"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import numpy as np
import pandas as pd


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and np.isnan(value)):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, np.integer)):
        return int(value)
    if isinstance(value, (float, np.floating)):
        return float(value)
    return str(value)


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    rows = [tuple(_cell(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))
