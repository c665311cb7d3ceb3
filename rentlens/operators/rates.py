"""Rate tables from coefficients and random effects. Sums of coefficients are sale/rent; rates are 1/sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ["Coef_all", "Coef_est", "Coef_loc", "Coef_year"]
#: the order in which the summaries by stratum and by locality, and the locality rates, are published
STRATUM_ORDER, LOCALITY_ORDER, PUBLISHED_ORDER = ["ESTRATO", "A"], ["CODIGO_LOCALIDAD", "A"], ["CODIGO_LOCALIDAD", "ESTRATO", "ANO"]


def _part(coefs: DataFrame, factor: str, key: str, name: str) -> DataFrame:
    return coefs.filter(F.col("FACTOR") == factor).select(F.col("NIVEL").alias(f"{key}_NIVEL"),
                                                          F.col("COEF").alias(name))


def rate_table(cohorts: DataFrame, coefs: DataFrame, ranef: DataFrame) -> DataFrame:
    """Coefficient sum of each distinct (sector, locality, year, stratum); absent coefficients count as 0."""
    out = cohorts.select("CODIGO_BARRIO", "CODIGO_LOCALIDAD", "ANO", "ESTRATO").distinct()
    out = out.join(ranef, "CODIGO_BARRIO", "left")
    common = coefs.filter(F.col("FACTOR") == "all").select("COEF").scalar()
    out = out.withColumn("Coef_all", common)
    for factor, key, name in (("est", "ESTRATO", "Coef_est"), ("loc", "CODIGO_LOCALIDAD", "Coef_loc"),
                              ("year", "ANO", "Coef_year")):
        part = _part(coefs, factor, key, name)
        out = out.join(part, F.col(key).cast("string") == F.col(f"{key}_NIVEL"), "left").drop(f"{key}_NIVEL")
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in PARTS})
    return out.withColumn("TASA_RENTA", F.col("Coef_all") + F.col("Coef_est") + F.col("Coef_loc")
                          + F.col("Coef_year") + F.col("RAN_EFFECT"))


def reciprocal(value: Column, digits: int) -> Column:
    return F.round(F.try_divide(F.lit(1.0), value), digits)


def _summary(rates: DataFrame, key: Column, name: str, parts: list[str]) -> DataFrame:
    total = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    return (rates.select(F.col("ANO").alias("A"), key.alias(name), F.round(total, 2).alias("TASA_RENTA"))
            .withColumn("TASA_RENTA_2", reciprocal(F.col("TASA_RENTA"), 4)).distinct())


def rates_by_stratum(rates: DataFrame) -> DataFrame:
    """Stratum and year: rounded coefficient sum and its reciprocal."""
    return _summary(rates, F.col("ESTRATO"), "ESTRATO", ["Coef_all", "Coef_est", "Coef_year"])


def rates_by_locality(rates: DataFrame) -> DataFrame:
    """Locality (as a number) and year: rounded coefficient sum and its reciprocal."""
    return _summary(rates, F.col("CODIGO_LOCALIDAD").try_cast("int"), "CODIGO_LOCALIDAD",
                    ["Coef_all", "Coef_loc", "Coef_year"])


def report_rates(summary: DataFrame) -> DataFrame:
    """Rate as published in the report, and in percent."""
    rate = reciprocal(F.col("TASA_RENTA"), 5)
    return (summary.drop("TASA_RENTA_2").withColumn("TASA_RENTA", rate)
            .withColumn("TASA_PORCENTAJE", F.col("TASA_RENTA") * 100))


def only_strata(df: DataFrame, strata: list[int]) -> DataFrame:
    """Part of a table that is shown on its own."""
    return df.filter(F.col("ESTRATO").isin(*strata))


def with_locality_names(df: DataFrame, localities: DataFrame) -> DataFrame:
    names = localities.select(F.col("CODIGO_LOCALIDAD").try_cast("int").alias("CODIGO_LOCALIDAD"),
                              "NOMBRE_LOCALIDAD")
    return df.join(names, "CODIGO_LOCALIDAD", "left")


def published_sector_rates(rates: DataFrame) -> DataFrame:
    return rates.select("ANO", "CODIGO_LOCALIDAD", "ESTRATO", "CODIGO_BARRIO",
                        reciprocal(F.col("TASA_RENTA"), 5).alias("TASA_RENTA"))


def published_locality_rates(rates: DataFrame) -> DataFrame:
    """Rate of each locality, stratum and year, without the sector effect."""
    total = sum((F.col(c) for c in PARTS[1:]), F.col(PARTS[0]))
    return rates.select("ANO", F.col("CODIGO_LOCALIDAD").try_cast("int").alias("CODIGO_LOCALIDAD"), "ESTRATO",
                        reciprocal(total, 5).alias("TASA_RENTA")).distinct()


def union_classes(apartments: DataFrame, houses: DataFrame) -> DataFrame:
    """Rates of both classes, tagged with the property type."""
    return (houses.withColumn("OFT_TIPO_INMUEBLE", F.lit("CASA"))
            .unionByName(apartments.withColumn("OFT_TIPO_INMUEBLE", F.lit("APARTAMENTO"))))
