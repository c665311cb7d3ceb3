"""Cohort means per sector, their imputation, and the sale-to-rent ratio window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.joins import null_safe_join
from rentlens.functions.quantiles import exact_medians
from rentlens.operators.clean import mean
from rentlens.sources.store import stage

PLACE = ["CODIGO_BARRIO", "NOMBRE_BARRIO", "CODIGO_LOCALIDAD", "NOMBRE_LOCALIDAD"]
COHORT = [*PLACE, "CLASE_PREDIO", "ESTRATO", "ANO"]
OFFERS = ("ARRIENDO", "VENTA")


def cohort_summary(df: DataFrame, stat: str = "mean") -> DataFrame:
    """Number of listings and mean (or exact median) value per m2 of each cohort and offer type."""
    by = [*COHORT, "TIPO_OFERTA"]
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("N"), F.avg("VALOR_M2_INTEGRAL").alias("PRECIO_MEAN"))
    if stat == "mean":
        return counts
    if stat != "median":
        raise ValueError("stat is 'mean' or 'median'")
    medians = exact_medians(df, by, {"VALOR_M2_INTEGRAL": "PRECIO_MEAN"})
    return null_safe_join(counts.drop("PRECIO_MEAN"), medians, by, "left")


def cohort_pivot(df: DataFrame, stat: str = "mean", weight: str | None = None) -> DataFrame:
    """One row per cohort with rent and sale columns; absent offer types are null, counts included.

    ``weight`` names the number of equal rows that a row stands for; medians have no such form.
    """
    def of(offer: str, value):
        return F.when(F.col("TIPO_OFERTA") == offer, value)

    if stat == "mean":
        # conditional aggregates need one shuffle where pivot needs two
        return df.groupBy(*COHORT).agg(
            *[mean(of(o, F.col("VALOR_M2_INTEGRAL")), weight).alias(f"PRECIO_MEAN_{o}") for o in OFFERS],
            *[F.sum(of(o, F.lit(1) if weight is None else F.col(weight))).alias(f"N_{o}") for o in OFFERS])
    if weight is not None:
        raise ValueError("weights go with stat 'mean'")
    return cohort_summary(df, stat).groupBy(*COHORT).agg(
        *[F.max(of(o, F.col(name))).alias(f"{name}_{o}") for name in ("PRECIO_MEAN", "N") for o in OFFERS])


def keep_cohorts(cohorts: DataFrame, min_sales: int = 5) -> DataFrame:
    """Cohorts with a rent, or with more than ``min_sales`` sales."""
    return cohorts.filter(F.col("PRECIO_MEAN_ARRIENDO").isNotNull() | (F.col("N_VENTA") > min_sales))


def cohort_table(df: DataFrame, stat: str = "mean", min_sales: int = 5, weight: str | None = None) -> DataFrame:
    return keep_cohorts(cohort_pivot(df, stat, weight), min_sales)


def locality_rent_mean(listings: DataFrame, by_year: bool = True, weight: str | None = None) -> DataFrame:
    """Mean rent per m2 by locality, class and stratum (and year)."""
    by = ["CODIGO_LOCALIDAD", "CLASE_PREDIO", "ESTRATO", *(["ANO"] if by_year else [])]
    return (listings.filter(F.col("TIPO_OFERTA") == "ARRIENDO").groupBy(*by)
            .agg(mean(F.col("VALOR_M2_INTEGRAL"), weight).alias("MEAN_ARRIENDO_LOC")))


def impute_sale(cohorts: DataFrame, cadastral: DataFrame) -> DataFrame:
    """Missing sale values from the cadastral table; cohorts it does not know are dropped."""
    known = cadastral.withColumnsRenamed({"CODIGO_ESTRATO": "ESTRATO", "VIGENCIA": "ANO"})
    joined = cohorts.join(known, ["CODIGO_BARRIO", "CLASE_PREDIO", "ESTRATO", "ANO"])
    return joined.withColumn("PRECIO_MEAN_VENTA", F.coalesce("PRECIO_MEAN_VENTA", "VALOR_INTEGRAL"))


def impute_rent(cohorts: DataFrame, listings: DataFrame, weight: str | None = None) -> DataFrame:
    """Missing rents from the locality's mean of the same class, stratum and year."""
    means = stage(locality_rent_mean(listings, weight=weight), "locality-rent")
    joined = cohorts.join(means, ["CODIGO_LOCALIDAD", "CLASE_PREDIO", "ESTRATO", "ANO"], "left")
    return (joined.withColumn("PRECIO_MEAN_ARRIENDO", F.coalesce("PRECIO_MEAN_ARRIENDO", "MEAN_ARRIENDO_LOC"))
            .drop("MEAN_ARRIENDO_LOC"))


def impute_cohorts(cohorts: DataFrame, listings: DataFrame, cadastral: DataFrame,
                   weight: str | None = None) -> DataFrame:
    return impute_rent(impute_sale(cohorts, cadastral), listings, weight)


def split_by_ratio(cohorts: DataFrame, low: float = 100.0, high: float = 300.0) -> DataFrame:
    """Label cohorts ``in`` (low <= sale/rent < high) or ``out``. Exactly ``high`` and null get no label."""
    ratio = F.try_divide(F.col("PRECIO_MEAN_VENTA"), F.col("PRECIO_MEAN_ARRIENDO"))
    label = (F.when((ratio >= low) & (ratio < high), "in")
             .when((ratio < low) | (ratio > high), "out"))
    return cohorts.withColumn("RATIO", ratio).withColumn("SPLIT", label)


def rejected_rows(listings: DataFrame, split: DataFrame) -> DataFrame:
    """Listings that belong to a cohort outside the ratio window."""
    keys = ["CODIGO_BARRIO", "ANO", "CLASE_PREDIO", "ESTRATO"]
    out = split.filter(F.col("SPLIT") == "out").select(
        *keys, "PRECIO_MEAN_ARRIENDO", "PRECIO_MEAN_VENTA", "N_ARRIENDO", "N_VENTA", "RATIO")
    return listings.join(out, keys)


def cohorts_without_rent(cohorts: DataFrame, listings: DataFrame) -> DataFrame:
    """Cohorts without any rent, next to the locality's mean rent over all years."""
    missing = cohorts.filter(F.col("PRECIO_MEAN_ARRIENDO").isNull())
    means = stage(locality_rent_mean(listings, by_year=False), "locality-rent")
    return missing.join(means, ["CODIGO_LOCALIDAD", "CLASE_PREDIO", "ESTRATO"], "left")


def cohort_coverage(split: DataFrame) -> DataFrame:
    """Sectors and offers by class, year and stratum, with the grand total (TOTAL = 1), in one pass."""
    return (split.filter(F.col("SPLIT") == "in")
            .groupingSets([["CLASE_PREDIO", "ANO", "ESTRATO"], []], "CLASE_PREDIO", "ANO", "ESTRATO")
            .agg(F.grouping("CLASE_PREDIO").cast("int").alias("TOTAL"),
                 F.count(F.lit(1)).alias("SECTORES"),
                 F.coalesce(F.sum("N_ARRIENDO"), F.lit(0)).alias("OFERTAS_ARRIENDO"),
                 F.coalesce(F.sum("N_VENTA"), F.lit(0)).alias("OFERTAS_VENTA")))
