"""Top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int = 5, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``tie`` columns, ascending, settle equal values.

    Runs as a per-partition top-k followed by a merge of those.
    """
    return df.orderBy(F.desc(by), *tie).limit(k)
