"""Data behind the diagnostic plots, and descriptive counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.quantiles import exact_quantiles


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts of equal-width bins over the column's range; empty bins are absent."""
    span = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    low, width = span["lo"], ((span["hi"] or 0.0) - (span["lo"] or 0.0)) / bins
    place = F.floor((F.col(col) - F.lit(low)) / F.lit(width)) if width else F.lit(0)
    return (df.filter(F.col(col).isNotNull())
            .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("BIN")).agg(F.count(F.lit(1)).alias("N"))
            .withColumn("DESDE", F.lit(low) + F.col("BIN") * F.lit(width)))


def five_numbers(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """Minimum, quartiles and maximum per group, exact for groups of any size."""
    names = ["MINIMO", "Q1", "MEDIANA", "Q3", "MAXIMO"]
    q = exact_quantiles(df, by, [col], [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.select(*by, *[F.col(f"{col}_q")[i].alias(n) for i, n in enumerate(names)])


def line_fit(df: DataFrame, y: str, x: str, by: list[str]) -> DataFrame:
    """Straight line of y on x per group."""
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("PENDIENTE"), F.regr_intercept(y, x).alias("INTERCEPTO"),
                               F.count(F.lit(1)).alias("N"))


def first_group(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the first group in key order, as picked for an illustration."""
    return df.join(df.select(*by).orderBy(*by).limit(1), by, "left_semi")


def listing_counts(df: DataFrame, sets: list[list[str]], more_than: dict[str, int] | None = None) -> DataFrame:
    """Listings for several column combinations in one pass; GRUPO names the combination.

    ``more_than`` has the number that a count of a combination must exceed to be shown.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    label = reduce(lambda out, s: F.when(
        reduce(lambda a, b: a & b, [F.grouping(c) == (0 if c in s else 1) for c in cols]),
        F.lit("+".join(s))).otherwise(out), sets, F.lit(None))
    counts = df.groupingSets(sets, *cols).agg(label.alias("GRUPO"), F.count(F.lit(1)).alias("N"))
    for name, least in (more_than or {}).items():
        counts = counts.filter((F.col("GRUPO") != name) | (F.col("N") > least))
    return counts


def distinct_count(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Distinct non-null values of ``col`` per group."""
    return (df.select(*by, col).distinct().groupBy(*by).agg(F.count(col).alias("N")))


def funnel_counts(raw: DataFrame, steps: dict[str, DataFrame]) -> DataFrame:
    """Rows of the raw table, of its homes, and of each later step."""
    homes = F.col("TIPO_INMUEBLE").isin("APARTAMENTO", "CASA")
    first = raw.agg(F.count(F.lit(1)).alias("total"), F.count_if(homes).alias("residencial"))
    out = first.unpivot([], ["total", "residencial"], "PASO", "N")
    for name, df in steps.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("N")).withColumn("PASO", F.lit(name)))
    return out
