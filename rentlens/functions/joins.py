"""Joins that match null keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner",
                   extra: Column | None = None) -> DataFrame:
    """Equi-join in which null equals null; one copy of the keys is kept."""
    renamed = b.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.lit(True))
    if extra is not None:
        on = on & extra
    return a.join(renamed, on, how).drop(*[f"__{k}" for k in keys])
