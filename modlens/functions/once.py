"""Evaluating costly expressions once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns whose expressions later filters will reuse instead of repeating.

    A filter on a computed column is pushed below the projection that computes it,
    and with it a copy of the expression.  For chains of regexes that multiplies the
    main cost of a scan.  Filters do not move below a generator, and ``stack(1, ...)``
    is a generator that gives back its one row.  The price: the columns are computed
    even where nothing reads them, so use it only right before such a filter.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.stack(F.lit(1), *columns.values()).alias(*columns))
