"""Small helpers that several operators share."""

from __future__ import annotations

import math

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.sources.store import stage  # noqa: F401  (re-exported)


def by_value(module) -> None:
    """Send a module's functions with the task, as workers need not have this package installed."""
    cloudpickle.register_pickle_by_value(module)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, a null text as the empty one; other columns cannot clash later."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def total_bytes(df: DataFrame, col: str = "text") -> int:
    """Bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(col).cast("long"))).first()[0] or 0


def chunk_count(total: int, least: int = 4 << 20) -> int:
    """Number of chunks of a corpus of ``total`` bytes: chunks of 4 MiB, growing with the root of very large corpora."""
    return max(1, math.ceil(total / max(least, 6 * math.sqrt(total))))


def hex_of(value: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
