"""Validation of rates on listings that carry both prices, and quality control of that second sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.quantiles import exact_quantiles, lattice_quantiles
from rentlens.functions.text import as_code, band, pad_left, strip_decimal
from rentlens.operators.clean import (COPIES, DEFLATORS, HOMES, clean_once, fee_by_priority, indexed, value_per_m2,
                                      with_census_fees)
from rentlens.operators.control import quality_control
from rentlens.sources.store import stage

COMMON = ["PRECIO", "VALOR_M2_INTEGRAL", "AREA_CONSTRUIDA", "CODIGO_BARRIO", "ESTRATO", "CLASE_PREDIO",
          "TIPO_OFERTA", "IDENTIFICADOR", "ANO", "BARMANPRE", "NOMBRE_BARRIO", "CODIGO_LOCALIDAD",
          "NOMBRE_LOCALIDAD"]

# fixed values: error bands in pesos per m2, and the quantiles reported
ERROR_EDGES = [0.0, 3e6, 5e6, 10e6, 15e6, 30e6, 50e6, 1000e6]
ERROR_LABELS = ["0-3", "3-5", "5-10", "10-15", "15-30", "30-50", "50-1000"]
ERROR_QUANTILES = [0.05, 0.1, 0.25, 0.4, 0.45, 0.5, 0.55, 0.6, 0.75, 0.9, 0.95]

SUMMARY_KEYS = ["OFT_TIPO_INMUEBLE", "NOMBRE_LOCALIDAD", "CODIGO_ESTRATO_SIIC"]


def join_rates(two_price: DataFrame, rates_sector: DataFrame, rates_locality: DataFrame) -> DataFrame:
    """Left-join the sector rate and the locality rate."""
    base = two_price.withColumn("CODIGO_BARRIO", pad_left(as_code(F.col("CODIGO_BARRIO")), 6))
    keys = {"ANO": "VIGENCIA", "ESTRATO": "CODIGO_ESTRATO_SIIC"}
    sector = (rates_sector.drop("CODIGO_LOCALIDAD").withColumnsRenamed({**keys, "TASA_RENTA": "TASA_SECTOR"})
              .withColumn("CODIGO_BARRIO", pad_left(strip_decimal(F.col("CODIGO_BARRIO")), 6)))
    locality = rates_locality.withColumnsRenamed({**keys, "TASA_RENTA": "TASA_LOCALIDAD"})
    return (base.join(sector, ["OFT_TIPO_INMUEBLE", "VIGENCIA", "CODIGO_BARRIO", "CODIGO_ESTRATO_SIIC"], "left")
            .join(locality, ["OFT_TIPO_INMUEBLE", "VIGENCIA", "CODIGO_LOCALIDAD", "CODIGO_ESTRATO_SIIC"], "left"))


def choose_rate(joined: DataFrame) -> DataFrame:
    """Sector rate, else locality rate; homes with a rate only."""
    return (joined.withColumn("TCR_ESTADISTICA", F.coalesce("TASA_SECTOR", "TASA_LOCALIDAD"))
            .filter(F.col("OFT_TIPO_INMUEBLE").isin(*HOMES) & F.col("TCR_ESTADISTICA").isNotNull()))


def with_lot_id(df: DataFrame, width: int = 2) -> DataFrame:
    """Lot id from sector, block and lot codes; ``width`` 0 joins them as they are."""
    parts = [as_code(F.col(c)) for c in ("CODIGO_MANZANA", "CODIGO_PREDIO")]
    if width:
        parts = [pad_left(p, width) for p in parts]
    return df.withColumn("BARMANPRE", F.concat(F.col("CODIGO_BARRIO"), *parts))


def net_rent(df: DataFrame, fee_census: DataFrame, deflators: dict[int, float] = DEFLATORS,
             default_deflator: float = 0.0) -> DataFrame:
    """Subtract the indexed administration fee from the rent."""
    priced = with_census_fees(df.withColumnRenamed("CODIGO_ESTRATO_SIIC", "ESTRATO"), fee_census)
    priced = priced.withColumnRenamed("ESTRATO", "CODIGO_ESTRATO_SIIC")
    priced = priced.withColumn("VALOR_ADMINISTRACION", fee_by_priority("OFT_TIPO_INMUEBLE"))
    fee = indexed(F.col("VALOR_ADMINISTRACION"), F.col("VIGENCIA"), deflators, default_deflator)
    return (priced.withColumn("VALOR_ADMINISTRACION_IPC", fee)
            .withColumn("VR_INICIAL_ARRIENDO", F.col("VR_INICIAL_ARRIENDO") - fee)
            .drop("VALOR_ADMINISTRACION_MODA", "MEDIANA_ADMON", "MEDIANA_ADMON_2"))


def plausible(df: DataFrame, low: float = 0.0033, high: float = 0.01) -> DataFrame:
    """Observed rate rent/sale, kept between the bounds (both included)."""
    rate = F.try_divide(F.col("VR_INICIAL_ARRIENDO"), F.col("VR_INICIAL_VENTA"))
    return df.withColumn("TCR_OIC", rate).filter(F.col("TCR_OIC").between(low, high))


def with_errors(df: DataFrame) -> DataFrame:
    """Estimated sale value, absolute error per m2, absolute difference of rates."""
    gap = F.abs(F.col("VR_INICIAL_VENTA") - F.col("VENTA_ESTIMADA"))
    return (df.withColumn("VENTA_ESTIMADA", F.try_divide(F.col("VR_INICIAL_ARRIENDO"), F.col("TCR_ESTADISTICA")))
            .withColumn("DIFERENCIAS", value_per_m2(gap, F.col("AREA_CONSTRUIDA_SIIC")))
            .withColumn("DIFERENCIAS_TCR", F.abs(F.col("TCR_ESTADISTICA") - F.col("TCR_OIC"))))


def apply_rates(two_price: DataFrame, rates_sector: DataFrame, rates_locality: DataFrame,
                fee_census: DataFrame) -> DataFrame:
    """Two-price listings with chosen rate, net rent, observed rate, estimate and errors."""
    chosen = choose_rate(join_rates(two_price, rates_sector, rates_locality))
    return with_errors(plausible(net_rent(with_lot_id(chosen), fee_census)))


def validation_summary(df: DataFrame) -> DataFrame:
    """Count and median errors by (type, locality, stratum), type, locality and stratum.

    NIVEL names the grouping. Values are counted once in the finest groups; all four groupings and their counts come from that
    table, and the exact medians also hold for groups of any size, such as all apartments.
    """
    levels = {"RESUMEN": SUMMARY_KEYS, "RESUMEN_CP": SUMMARY_KEYS[:1], "RESUMEN_LOC": SUMMARY_KEYS[1:2],
              "RESUMEN_EST": SUMMARY_KEYS[2:]}
    names = {"DIFERENCIAS": "ERROR_TOTAL_MEDIO", "DIFERENCIAS_TCR": "DIF_TCR"}
    q = lattice_quantiles(df.dropna(subset=SUMMARY_KEYS), levels, list(names), [0.5], "CODIGO_RESTO")
    return q.select(F.col("LEVEL").alias("NIVEL"), *SUMMARY_KEYS, F.col("N").alias("NUM_PREDIOS"),
                    *[F.col(f"{c}_q")[0].alias(name) for c, name in names.items()])


def validation_tables(df: DataFrame) -> dict[str, DataFrame]:
    """What the validation publishes: its rows and the four summaries, each ordered by its keys."""
    summary = stage(validation_summary(df), "summary")
    return {"BASE_FINAL": df} | {name: summary.filter(F.col("NIVEL") == name).drop("NIVEL").orderBy(*SUMMARY_KEYS)
                                 for name in ("RESUMEN", "RESUMEN_CP", "RESUMEN_LOC", "RESUMEN_EST")}


def error_bands(df: DataFrame) -> DataFrame:
    return (df.withColumn("CAT_DIFERENCIA", band(F.col("DIFERENCIAS"), ERROR_EDGES, ERROR_LABELS, "VACIO"))
            .groupBy("CAT_DIFERENCIA").agg(F.count(F.lit(1)).alias("N")))


def error_quantiles(df: DataFrame, kind: str = "APARTAMENTO") -> DataFrame:
    """Error quantiles in millions, one row per probability."""
    rows = df.filter(F.col("OFT_TIPO_INMUEBLE") == kind).select("DIFERENCIAS")
    q = exact_quantiles(rows, [], ["DIFERENCIAS"], ERROR_QUANTILES)
    probs = F.array(*[F.lit(p) for p in ERROR_QUANTILES])
    pairs = F.explode(F.arrays_zip(probs.alias("PROB"), F.col("DIFERENCIAS_q").alias("Q"))).alias("z")
    return q.select(pairs).select("z.PROB", (F.col("z.Q") / 1e6).alias("MILLONES"))


def price_correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of final and estimated sale value."""
    known = df.filter(F.col("VENTA_ESTIMADA").isNotNull())
    return known.agg(F.corr("VR_FINAL_VENTA", "VENTA_ESTIMADA").alias("CORR"))


def unpivot_prices(two_price: DataFrame) -> DataFrame:
    """One row per offer type: rent and sale of the same property become two listings."""
    ids = [c for c in two_price.columns if c not in ("VR_INICIAL_ARRIENDO", "VR_INICIAL_VENTA")]
    long = two_price.unpivot(ids, ["VR_INICIAL_ARRIENDO", "VR_INICIAL_VENTA"], "TIPO_OFERTA", "PRECIO")
    return long.withColumn("TIPO_OFERTA", F.regexp_replace("TIPO_OFERTA", "VR_INICIAL_", ""))


def as_listings(two_price: DataFrame) -> DataFrame:
    """The second sample in the columns of the listings."""
    long = unpivot_prices(two_price).withColumnsRenamed({
        "AREA_CONSTRUIDA_SIIC": "AREA_CONSTRUIDA", "CODIGO_ESTRATO_SIIC": "ESTRATO",
        "CLASE_PREDIO_SIIC": "CLASE_PREDIO", "VIGENCIA": "ANO"})
    if "NOMBRE_BARRIO" not in long.columns:
        long = long.withColumn("NOMBRE_BARRIO", F.lit(None).cast("string"))
    return (with_lot_id(long, 0)
            .withColumn("IDENTIFICADOR", as_code(F.col("OFT_CODIGO")))
            .withColumn("VALOR_M2_INTEGRAL", value_per_m2(F.col("PRECIO"), F.col("AREA_CONSTRUIDA")))
            .select(*COMMON))


def union_samples(two_price: DataFrame, listings: DataFrame) -> DataFrame:
    """Second sample and cleaned listings in one table, told apart by MARCA; listings kept once keep their copies."""
    test, more = as_listings(two_price).withColumn("MARCA", F.lit("Test")), []
    if COPIES in listings.columns:
        test, more = test.withColumn(COPIES, F.lit(1).cast("long")), [COPIES]
    return test.unionByName(listings.select(*COMMON, *more).withColumn("MARCA", F.lit("Train")))


def keep_survivors(two_price: DataFrame, survivors: DataFrame, repeat: bool = False) -> DataFrame:
    """Second-sample rows whose id survived. ``repeat`` keeps a copy per surviving price, as published."""
    test = survivors.filter(F.col("MARCA") == "Test")
    if repeat and COPIES in test.columns:
        test = test.withColumn("copy", F.explode(F.sequence(F.lit(1), COPIES)))
    ids = test.select(F.col("IDENTIFICADOR").alias("OFT_CODIGO"))
    return two_price.join(ids, "OFT_CODIGO", "inner" if repeat else "left_semi")


def screen_second_sample(two_price: DataFrame, listings: DataFrame, fee_census: DataFrame,
                         repeat: bool = False) -> DataFrame:
    """Clean and quality-control the second sample among the listings; its surviving rows.

    The control does not look at fees, so every row goes through it once, with its copies.
    """
    united = union_samples(two_price, listings)
    cleaned = clean_once(united, fee_census)
    return keep_survivors(two_price, quality_control(cleaned, weight=COPIES), repeat)
