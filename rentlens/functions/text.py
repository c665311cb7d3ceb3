"""String and code expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_money(col: Column) -> Column:
    """``"$1,234"`` -> 1234.0; text that is no number, or not a finite one, becomes null."""
    # not translate, which makes a text of every character
    value = F.replace(F.replace(col, F.lit("$")), F.lit(",")).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def parse_fee(col: Column, min_fee: float = 10000.0) -> Column:
    """Money text, with or without a ``.00`` tail; fees not above ``min_fee`` become null."""
    value = parse_money(col)
    return F.when(value > min_fee, value)


def as_code(col: Column) -> Column:
    return col.cast("string")


def strip_decimal(col: Column) -> Column:
    """Text form of a code read as a number: ``1101.0`` -> ``1101``."""
    return F.regexp_replace(col.cast("string"), r"\.0$", "")


def pad_left(col: Column, width: int) -> Column:
    """Left zero-pad. A fixed ``lpad`` would cut longer codes."""
    return F.lpad(col, F.greatest(F.length(col), F.lit(width)), F.lit("0"))


def common_prefix_length(a: Column, b: Column, longest: int = 5) -> Column:
    """Length of the shared prefix, at most ``longest``."""
    out = F.lit(0)
    for k in range(1, longest + 1):
        same = (F.substring(a, 1, k) == F.substring(b, 1, k)) & (F.length(a) >= k) & (F.length(b) >= k)
        out = F.when(same, F.lit(k)).otherwise(out)
    return out


def code_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length: 1 for equal codes, 0 for nothing in common."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def format_thousands(col: Column) -> Column:
    """1234567 -> ``1.234.567``."""
    return F.translate(F.format_number(col, 0), ",", ".")


def band(col: Column, edges: list[float], labels: list[str], other: str | None = None) -> Column:
    """Label of the open range ``(edges[i], edges[i+1])`` holding the value; a value on an edge is in none."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per range is needed")
    out = F.lit(other)
    for low, high, label in zip(edges, edges[1:], labels):
        out = F.when((col > low) & (col < high), F.lit(label)).otherwise(out)
    return out


def _normal(name: str) -> str:
    ascii_name = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", ascii_name)
    name = re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").upper()
    return f"X{name}" if not name or name[0].isdigit() else name


def normalise_names(df: DataFrame) -> DataFrame:
    """ASCII, upper-case, underscore-separated column names; repeats get a number."""
    seen: dict[str, int] = {}
    names = []
    for raw in df.columns:
        name = _normal(raw)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)
