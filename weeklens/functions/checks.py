"""Column contracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df
