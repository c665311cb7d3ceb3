"""Listing cleaning: parsing, codes, exclusions, administration fee, net price."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.joins import null_safe_join
from rentlens.functions.quantiles import lattice_quantiles
from rentlens.functions.text import as_code, pad_left, parse_fee, parse_money
from rentlens.sources.store import stage

SEGMENT = ["ANO", "CLASE_PREDIO", "ESTRATO", "TIPO_OFERTA"]
HOMES = ("APARTAMENTO", "CASA")
COPIES = "COPIES"  #: rows that a listing kept once stands for: one for each distinct census fee of its lot
MEDIANS = ["MEDIANA_ADMON", "MEDIANA_ADMON_2"]

# fixed values: yearly price-index factors applied to the administration fee
DEFLATORS = {2017: 1 - 0.0463, 2018: 1.0, 2019: 1 + 0.0349, 2020: (1 + 0.0117) * (1 + 0.0349)}


def only_homes(df: DataFrame, kind: str = "TIPO_INMUEBLE") -> DataFrame:
    """Apartments and houses that have a stratum."""
    return df.filter(F.col(kind).isin(*HOMES) & (F.col("ESTRATO") > 0))


def pad_codes(df: DataFrame) -> DataFrame:
    """Sector code to 6 and lot id to 10 digits."""
    return df.withColumns({"CODIGO_BARRIO": pad_left(as_code(F.col("CODIGO_BARRIO")), 6),
                           "BARMANPRE": pad_left(as_code(F.col("BARMANPRE")), 10)})


def exclusions(df: DataFrame) -> DataFrame:
    """Urban listings with a built area, a lot id and a stratum.

    A padded urban code starts with 0, so a raw one is short or starts with 0. Tests on the raw columns reach
    the scan, where tests on padded ones would not: exclude first, then pad.
    """
    code = as_code(F.col("CODIGO_BARRIO"))
    return df.filter(((F.length(code) < 6) | code.startswith("0"))
                     & (F.col("AREA_CONSTRUIDA") > 0)
                     & (F.trim(as_code(F.col("BARMANPRE"))) != "")
                     & (F.col("ESTRATO") > 0))


def with_segment_key(df: DataFrame) -> DataFrame:
    """Text key of the segment. Operators group on its four columns instead."""
    return df.withColumn("key", F.concat_ws("_", *SEGMENT))


def sector_of_lot(lot: Column) -> Column:
    """Sector code held in the first 6 digits of a lot id, also where leading zeros were lost."""
    return F.substring(pad_left(as_code(lot), 10), 1, 6)


def fee_medians(fee_census: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact median fee by (sector, stratum) and by sector."""
    census = fee_census.select(sector_of_lot(F.col("BARMANPRE_AJUSTADO")).alias("CODIGO_BARRIO"),
                               "ESTRATO", "VALOR_ADMINISTRACION_MODA")
    levels = {"both": ["CODIGO_BARRIO", "ESTRATO"], "sector": ["CODIGO_BARRIO"]}
    q = stage(lattice_quantiles(census, levels, ["VALOR_ADMINISTRACION_MODA"], [0.5]), "fee-medians")
    median = F.col("VALOR_ADMINISTRACION_MODA_q")[0]
    by_both, by_sector = (q.filter(F.col("LEVEL") == level).select(*keys, median.alias(name)) for (level, keys), name in
                          zip(levels.items(), ("MEDIANA_ADMON", "MEDIANA_ADMON_2")))
    return by_both, by_sector


def lot_fees(fee_census: DataFrame) -> DataFrame:
    """Distinct (lot, fee) pairs, so that repeated census rows do not repeat listings."""
    return (fee_census.select(pad_left(as_code(F.col("BARMANPRE_AJUSTADO")), 10).alias("BARMANPRE"),
                              "VALOR_ADMINISTRACION_MODA")
            .filter(F.col("BARMANPRE").isNotNull()).distinct())


def lots_with_several_fees(fee_census: DataFrame) -> DataFrame:
    """Lots whose census rows disagree; the join on lot id repeats the listings of these."""
    return (lot_fees(fee_census).groupBy("BARMANPRE").agg(F.count(F.lit(1)).alias("FEES"))
            .filter(F.col("FEES") > 1))


def lot_copies(fee_census: DataFrame) -> DataFrame:
    """How often the join on lot id repeats a listing of each lot; as many rows as lots, whatever their fees."""
    return lot_fees(fee_census).groupBy("BARMANPRE").agg(F.count(F.lit(1)).alias(COPIES))


def with_census_fees(df: DataFrame, fee_census: DataFrame) -> DataFrame:
    """Left-join the lot's own fee and the two medians, which come from a stage table, so that Catalyst sees their size."""
    by_both, by_sector = fee_medians(fee_census)
    return (df.join(lot_fees(fee_census), "BARMANPRE", "left")
            .join(by_both, ["CODIGO_BARRIO", "ESTRATO"], "left")
            .join(by_sector, "CODIGO_BARRIO", "left"))


def fee_by_priority(kind: str, own: Column | None = None) -> Column:
    """Own fee, lot fee, median of (sector, stratum), median of the sector, 0. Houses pay none."""
    steps = [F.col("VALOR_ADMINISTRACION_MODA"), F.col("MEDIANA_ADMON"), F.col("MEDIANA_ADMON_2"), F.lit(0.0)]
    fee = F.coalesce(*([own] if own is not None else []), *steps)
    return F.when(F.col(kind) == "CASA", F.lit(0.0)).otherwise(fee)


def indexed(amount: Column, year: Column, deflators: dict[int, float] = DEFLATORS,
            default: float = 1.0) -> Column:
    """Amount times its year's factor."""
    factor = F.lit(float(default))
    for y, f in deflators.items():
        factor = F.when(year == y, F.lit(f)).otherwise(factor)
    return amount * factor


def value_per_m2(price: Column, area: Column) -> Column:
    return F.try_divide(price, area)


def mean(value: Column, weight: str | None = None) -> Column:
    """Mean of the values, each counted as often as ``weight`` says."""
    if weight is None:
        return F.avg(value)
    return F.try_divide(F.sum(value * F.col(weight)), F.sum(F.when(value.isNotNull(), F.col(weight))))


def fill_group_mean(df: DataFrame, cols: list[str], by: list[str], weight: str | None = None) -> DataFrame:
    """Replace nulls by the group's mean. An aggregate and a join, so a huge group is never one task."""
    means = stage(df.groupBy(*by).agg(*[mean(F.col(c), weight).alias(f"{c}__mean") for c in cols]), "group-means")
    filled = null_safe_join(df, means, by, "left")
    return filled.withColumns({c: F.coalesce(c, f"{c}__mean") for c in cols}).drop(*[f"{c}__mean" for c in cols])


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.fillna(0, cols)


def parsed_listings(listings: DataFrame, min_fee: float = 10000.0) -> DataFrame:
    """Types, padded codes and parsed money; absent optional columns become null."""
    for name in ("TIPO_INMUEBLE", "VALOR_ADMINISTRACION"):
        if name not in listings.columns:
            listings = listings.withColumn(name, F.lit(None).cast("string"))
    ids = ("IDENTIFICADOR", "NOMBRE_BARRIO", "NOMBRE_LOCALIDAD", "CODIGO_LOCALIDAD")
    return pad_codes(listings).withColumns({
        **{c: as_code(F.col(c)) for c in ids if c in listings.columns},
        "PRECIO": parse_money(F.col("PRECIO").cast("string")),
        "VALOR_ADMINISTRACION": parse_fee(F.col("VALOR_ADMINISTRACION").cast("string"), min_fee)})


def clean_listings(listings: DataFrame, fee_census: DataFrame, min_fee: float = 10000.0,
                   net_of_fee: bool = False, deflators: dict[int, float] = DEFLATORS,
                   default_deflator: float = 1.0) -> DataFrame:
    """Cleaned listings with VALOR_ADMON and VALOR_ADMON_IPC.

    The published method leaves rents gross; ``net_of_fee`` subtracts the indexed fee from them.
    """
    kept = parsed_listings(exclusions(listings), min_fee)
    priced = _with_fee(with_census_fees(kept, fee_census), deflators, default_deflator)
    if net_of_fee:
        is_rent = F.col("TIPO_OFERTA") == "ARRIENDO"
        priced = priced.withColumn(
            "PRECIO", F.when(is_rent, F.col("PRECIO") - F.col("VALOR_ADMON_IPC")).otherwise(F.col("PRECIO")))
    return (with_segment_key(priced).filter(F.col("PRECIO") > 0)
            .drop("VALOR_ADMINISTRACION_MODA", *MEDIANS))


def _with_fee(joined: DataFrame, deflators: dict[int, float], default_deflator: float) -> DataFrame:
    """The fee by priority and its indexed value, from the census columns."""
    priced = joined.withColumn("VALOR_ADMON", fee_by_priority("TIPO_INMUEBLE", F.col("VALOR_ADMINISTRACION")))
    return priced.withColumn(
        "VALOR_ADMON_IPC", indexed(F.col("VALOR_ADMON"), F.col("ANO"), deflators, default_deflator))


def clean_once(listings: DataFrame, fee_census: DataFrame, min_fee: float = 10000.0,
               save: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``clean_listings`` with rents gross, each listing once: COPIES rows that differ in the lot's fee only.

    The medians stay as columns; ``with_each_fee`` gives the rows themselves. The fees of a lot multiply its rows, so
    what does not look at fees is done before. Copies that the listings have already are multiplied. ``save`` stores the
    rows, also those without a price, which the result leaves out when it is read.
    """
    by_both, by_sector = fee_medians(fee_census)
    lots = stage(lot_copies(fee_census), "lot-copies").withColumnRenamed(COPIES, "lot_copies")
    rows = parsed_listings(exclusions(listings), min_fee)
    before = F.col(COPIES) if COPIES in rows.columns else F.lit(1)
    joined = (rows.join(lots, "BARMANPRE", "left").join(by_both, ["CODIGO_BARRIO", "ESTRATO"], "left")
              .join(by_sector, "CODIGO_BARRIO", "left"))
    copies = before * F.coalesce("lot_copies", F.lit(1))
    once = with_segment_key(joined.withColumn(COPIES, copies.cast("long")).drop("lot_copies"))
    # rows are written once, parsed and joined. The price is tested on the stored column: a test before would parse it again,
    # ahead of all else
    return (save or stage)(once, "parsed").filter(F.col("PRECIO") > 0)


def with_each_fee(once: DataFrame, fee_census: DataFrame, deflators: dict[int, float] = DEFLATORS,
                  default_deflator: float = 1.0) -> DataFrame:
    """The rows of ``clean_listings`` from those of ``clean_once``, also after some of them were left out."""
    own = [c for c in once.columns if c not in (COPIES, *MEDIANS)]
    place = own.index("key")
    rows = _with_fee(once.join(lot_fees(fee_census), "BARMANPRE", "left"), deflators, default_deflator)
    return rows.select(*own[:place], "VALOR_ADMON", "VALOR_ADMON_IPC", *own[place:])


def exclusion_counts(listings: DataFrame) -> DataFrame:
    """Rows hit by each exclusion, before cleaning; a row may count several times."""
    counted = listings.agg(
        F.count_if(F.substring("CODIGO_BARRIO", 1, 1).isin("1", "2")).alias("Rurales"),
        F.count_if((F.col("AREA_CONSTRUIDA") == 0) | F.col("AREA_CONSTRUIDA").isNull()).alias("Sin área"),
        F.count_if((F.col("BARMANPRE") == "") | F.col("BARMANPRE").isNull()).alias("Sin Barmanpre"),
        F.count_if(F.col("ESTRATO") == 0).alias("Sin estrato"))
    return counted.unpivot([], counted.columns, "EXCLUSION", "N")
