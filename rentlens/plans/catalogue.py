"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.functions import text
from rentlens.operators import (clean, cohort, control, design, diagnostics, mixed, ols, pooling, rates,
                                validate)
from rentlens.plans.fixtures import Tables
from rentlens.plans.study import ClassStudy, Study
from rentlens.sources import schemas, tables
from rentlens.sources.publication import Ordered, Publication
from rentlens.sources.steps import Steps
from rentlens.sources.store import Store, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SEGMENT = clean.SEGMENT
COHORT = cohort.COHORT
N_COLUMNS = ("N_ARRIENDO", "N_VENTA")
CLASSES = ("P", "N")


class Inputs(Tables):
    """Fixture views and the steps that several queries start from."""

    @cached_property
    def study(self) -> Study:
        """The steps that this query asks for, from the tables as they are now."""
        self.stored_rows  # listings and cadastral values are made of them
        return Study(self.listings, self.fee_census, self.cadastral)

    @cached_property
    def urban(self) -> DataFrame:
        """Listings after the exclusions, with numbers parsed; derived once for a query, whatever its steps."""
        return stage(clean.parsed_listings(clean.exclusions(clean.only_homes(self.listings))))

    @property
    def cohorts(self) -> DataFrame:
        return cohort.cohort_table(self.urban)

    @property
    def imputed(self) -> DataFrame:
        self.stored_rows  # listings and cadastral values are made of them
        return cohort.impute_cohorts(self.cohorts, self.urban, self.cadastral)

    @cached_property
    def split(self) -> DataFrame:
        return stage(cohort.split_by_ratio(self.imputed))

    @cached_property
    def classes(self) -> dict[str, DataFrame]:
        """Cohorts that the model of each property class is fitted on."""
        inside = stage(self.split.filter(F.col("SPLIT") == "in"))
        return {kind: inside.filter(F.col("CLASE_PREDIO") == kind) for kind in CLASSES}

    @cached_property
    def fixed_rates(self) -> DataFrame:
        """Rate table from fixed coefficients."""
        inside = self.split.filter(F.col("SPLIT") == "in")
        return stage(rates.rate_table(inside, self.coefs, self.ranef), "fixed-rates")

    @property
    def validated(self) -> DataFrame:
        return validate.apply_rates(self.two_price, self.rates_sector, self.rates_locality, self.fee_census)


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, folder: fn(Inputs(spark, folder))
    return fn


def _doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _rounded(name: str, digits: int):
    """Rounded column for comparison; adding 0 turns -0.0 into 0.0."""
    return (F.round(name, digits) + F.lit(0.0)).alias(name)


def _labelled(parts: dict[str, DataFrame]) -> DataFrame:
    """The tables of the property classes as one, told apart by CLASE_PREDIO."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn("CLASE_PREDIO", F.lit(kind)) for kind, df in parts.items()])


def _by_class(t: Inputs, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make`` of the cohorts of each property class."""
    return _labelled({kind: make(rows) for kind, rows in t.classes.items()})


def _study_by_class(t: Inputs, make: Callable[[ClassStudy], DataFrame]) -> DataFrame:
    return _labelled({kind: make(t.study.classes[kind]) for kind in CLASSES})


# ---- sources -------------------------------------------------------------------------------------------

@query
def src_listings(t: Inputs) -> DataFrame:
    path = Store(t.spark, "listings").path("listings.tab")
    tables.write_csv(t.listings, path, "\t")
    return tables.read_listings(t.spark, path)


#: last digit of the id -> the line that stands for the listing in ``_faulty``
FAULTS = {"2": "no number in two columns", "4": "a field less", "5": "a field more", "6": "a byte that is no text"}


def _faulty(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """All listings written as text, some lines with a fault, and read again: accepted rows and rejected lines."""
    names = [f.name for f in schemas.LISTINGS]
    last = F.right("IDENTIFICADOR", F.lit(1))
    fields = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names}
    fields["ESTRATO"] = F.when(last == "2", "tres").otherwise(fields["ESTRATO"])
    fields["ANO"] = F.when(last == "2", "20l9").otherwise(fields["ANO"])
    line = F.concat_ws("\t", *[fields[n] for n in names[:-1]], F.when(last != "4", fields[names[-1]]),
                       F.when(last == "5", "more"))
    # 0xFF is in no text of UTF-8
    whole = F.when(last == "6", F.concat(F.encode(line, "UTF-8"), F.unhex(F.lit("FF")))).otherwise(F.encode(line, "UTF-8"))
    path = Store(t.spark, "faulty").path("listings.tab")
    t.listings.select(whole.cast("string").alias("value")).write.text(path)
    return tables.read_checked(t.spark, path, schemas.LISTINGS, header=False)


@query
def src_rejected(t: Inputs) -> DataFrame:
    """Lines that don't follow the schema, with the reasons."""
    return _faulty(t)[1].select("IDENTIFICADOR", "TIPO_OFERTA", "PRECIO", "ANO", F.concat_ws(",", tables.REASONS).alias("MOTIVOS"))


@query
def src_rejected_counts(t: Inputs) -> DataFrame:
    return tables.rejected_counts(_faulty(t)[1])


@query
def src_accepted(t: Inputs) -> DataFrame:
    """Rows of the lines that follow the schema."""
    return _faulty(t)[0]


@query
def src_cadastral(t: Inputs) -> DataFrame:
    store = Store(t.spark, "cadastral")
    store.save(t.cadastral, "resumen")
    return tables.read_table(t.spark, store.path("resumen"), schemas.CADASTRAL)


@query
def src_normalised_names(t: Inputs) -> DataFrame:
    raw = t.offers.select(F.col("CODIGO_BARRIO").alias("Código Barrio"), F.col("ANO").alias("Año"),
                          F.col("VALOR_M2_INTEGRAL").alias("valorM2 (integral)"),
                          F.col("PRECIO").alias("Precio"), F.col("ESTRATO").alias("precio"))
    return text.normalise_names(raw)


# ---- cleaning ------------------------------------------------------------------------------------------

@query
def clean_filter_type(t: Inputs) -> DataFrame:
    mixed_types = t.listings.withColumns({
        "TIPO_INMUEBLE": F.when(F.col("NOMBRE_FUENTE") == "src3", "LOCAL").otherwise(F.col("TIPO_INMUEBLE")),
        "ESTRATO": F.when(F.col("NOMBRE_FUENTE") == "src2", F.col("ESTRATO") - 1).otherwise(F.col("ESTRATO"))})
    return clean.only_homes(mixed_types).select("IDENTIFICADOR", "TIPO_INMUEBLE", "ESTRATO")


@query
def clean_parse_price(t: Inputs) -> DataFrame:
    return t.listings.select("IDENTIFICADOR", text.parse_money(F.col("PRECIO")).alias("PRECIO"))


@query
def clean_parse_fee(t: Inputs) -> DataFrame:
    fee = text.parse_fee(F.col("VALOR_ADMINISTRACION"))
    return t.listings.select("IDENTIFICADOR", fee.alias("VALOR_ADMINISTRACION"))


@query
def clean_pad_codes(t: Inputs) -> DataFrame:
    return clean.pad_codes(t.listings).select("IDENTIFICADOR", "CODIGO_BARRIO", "BARMANPRE")


@query
def clean_exclusions(t: Inputs) -> DataFrame:
    return clean.pad_codes(clean.exclusions(t.listings)).select(
        "IDENTIFICADOR", "CODIGO_BARRIO", "BARMANPRE", "AREA_CONSTRUIDA", "ESTRATO")


@query
def clean_segment_key(t: Inputs) -> DataFrame:
    return clean.with_segment_key(t.listings).groupBy("key").agg(F.count(F.lit(1)).alias("N"))


@query
def fee_median_sector(t: Inputs) -> DataFrame:
    return clean.fee_medians(t.fee_census)[1]


@query
def fee_median_stratum(t: Inputs) -> DataFrame:
    return clean.fee_medians(t.fee_census)[0]


@query
def join_fee_lot(t: Inputs) -> DataFrame:
    joined = t.urban.join(clean.lot_fees(t.fee_census), "BARMANPRE", "left")
    return joined.select("IDENTIFICADOR", "BARMANPRE", "VALOR_ADMINISTRACION_MODA")


@query
def lots_with_several_fees(t: Inputs) -> DataFrame:
    # an exact copy of a lot's fee is no conflict, a halved one is
    copies = t.fee_census.withColumn("VALOR_ADMINISTRACION_MODA", F.when(
        F.col("ESTRATO") == 4, F.col("VALOR_ADMINISTRACION_MODA") / 2).otherwise(F.col("VALOR_ADMINISTRACION_MODA")))
    return clean.lots_with_several_fees(t.fee_census.unionByName(copies))


@query
def fee_cascade(t: Inputs) -> DataFrame:
    return clean.clean_listings(t.listings, t.fee_census).select(
        "IDENTIFICADOR", "CODIGO_BARRIO", "ESTRATO", "TIPO_INMUEBLE", "VALOR_ADMON")


@query
def fee_indexed(t: Inputs) -> DataFrame:
    return clean.clean_listings(t.listings, t.fee_census).select("IDENTIFICADOR", "ANO", "VALOR_ADMON_IPC")


@query
def price_net(t: Inputs) -> DataFrame:
    cleaned = clean.clean_listings(t.listings, t.fee_census, net_of_fee=True)
    return cleaned.select("IDENTIFICADOR", "TIPO_OFERTA", "PRECIO")


@query
def clean_listings(t: Inputs) -> DataFrame:
    return clean.clean_listings(clean.only_homes(t.listings), t.fee_census).select(
        "IDENTIFICADOR", "CODIGO_BARRIO", "BARMANPRE", "PRECIO", "AREA_CONSTRUIDA", "VALOR_ADMON", "key")


@query
def value_per_m2(t: Inputs) -> DataFrame:
    return t.offers.select("IDENTIFICADOR", clean.value_per_m2(
        F.col("PRECIO"), F.col("AREA_CONSTRUIDA")).alias("VALOR_M2"))


@query
def fill_segment_mean(t: Inputs) -> DataFrame:
    return clean.fill_group_mean(t.offers, ["AREA_CONSTRUIDA"], SEGMENT).select("IDENTIFICADOR", "AREA_CONSTRUIDA")


@query
def fill_zero(t: Inputs) -> DataFrame:
    return clean.fill_zero(t.offers, ["VALOR_ADMINISTRACION"]).select("IDENTIFICADOR", "VALOR_ADMINISTRACION")


@query
def code_similarity(t: Inputs) -> DataFrame:
    return t.offers.select("IDENTIFICADOR", "CODIGO_BARRIO", text.code_similarity(
        F.col("IDENTIFICADOR"), F.col("CODIGO_BARRIO")).alias("SIMILITUD"))


@query
def code_prefix_len(t: Inputs) -> DataFrame:
    other = text.pad_left(F.col("IDENTIFICADOR"), 8)
    return t.offers.select("IDENTIFICADOR", "CODIGO_BARRIO", text.common_prefix_length(
        F.col("CODIGO_BARRIO"), other).alias("PREFIJO"))


@query
def fmt_counts(t: Inputs) -> DataFrame:
    return t.offers.groupBy("CODIGO_LOCALIDAD", "TIPO_OFERTA").agg(
        text.format_thousands(F.sum("PRECIO")).alias("TOTAL"),
        text.format_thousands(F.count(F.lit(1))).alias("N"))


@query
def val_lot_id(t: Inputs) -> DataFrame:
    plain = validate.with_lot_id(t.two_price, 0).withColumnRenamed("BARMANPRE", "BARMANPRE_2")
    return validate.with_lot_id(plain).select("OFT_CODIGO", "BARMANPRE", "BARMANPRE_2")


@query
def exclusion_counts(t: Inputs) -> DataFrame:
    return clean.exclusion_counts(clean.pad_codes(t.listings))


@query
def funnel_counts(t: Inputs) -> DataFrame:
    return diagnostics.funnel_counts(t.listings, {"depurada": t.urban})


@query
def listing_counts(t: Inputs) -> DataFrame:
    """Sources of all listings; everything else of the cleaned ones, strata of homes only."""
    cleaned = t.urban
    sets = [["TIPO_INMUEBLE"], ["ANO", "NOMBRE_FUENTE"], ["ANO", "TIPO_OFERTA"], ["ANO", "CLASE_PREDIO"],
            ["ANO", "TIPO_INMUEBLE"], ["ANO", "TIPO_OFERTA", "NOMBRE_FUENTE"]]
    shown = {"TIPO_INMUEBLE": 2000, "ANO+TIPO_INMUEBLE": 2000}
    homes = cleaned.filter(F.col("TIPO_INMUEBLE").isin("APARTAMENTO", "CASA"))
    counts = (diagnostics.listing_counts(cleaned, sets, shown)
              .unionByName(diagnostics.listing_counts(t.listings, [["NOMBRE_FUENTE"]]), allowMissingColumns=True)
              .unionByName(diagnostics.listing_counts(homes, [["TIPO_INMUEBLE", "ESTRATO"]]), allowMissingColumns=True))
    return _doubles(counts, "ESTRATO", "ANO")


@query
def distinct_count_per_group(t: Inputs) -> DataFrame:
    return diagnostics.distinct_count(t.offers, ["CODIGO_BARRIO", "CLASE_PREDIO"], "BARMANPRE")


# ---- cohorts -------------------------------------------------------------------------------------------

@query
def cohort_summary_mean(t: Inputs) -> DataFrame:
    return cohort.cohort_summary(t.urban)


@query
def cohort_summary_median(t: Inputs) -> DataFrame:
    return cohort.cohort_summary(t.urban, "median")


@query
def cohort_pivot(t: Inputs) -> DataFrame:
    return _doubles(cohort.cohort_pivot(t.urban), *N_COLUMNS)


@query
def cohort_keep(t: Inputs) -> DataFrame:
    return _doubles(cohort.cohort_table(t.urban), *N_COLUMNS)


@query
def cohort_keep_median(t: Inputs) -> DataFrame:
    return _doubles(cohort.cohort_table(t.urban, "median"), *N_COLUMNS)


@query
def locality_rent_mean(t: Inputs) -> DataFrame:
    return cohort.locality_rent_mean(t.urban)


@query
def locality_rent_mean_all_years(t: Inputs) -> DataFrame:
    return cohort.locality_rent_mean(t.urban, by_year=False)


@query
def impute_sale(t: Inputs) -> DataFrame:
    return cohort.impute_sale(t.cohorts, t.cadastral).select(
        "CODIGO_BARRIO", "CLASE_PREDIO", "ESTRATO", "ANO", "PRECIO_MEAN_VENTA", "VALOR_INTEGRAL")


@query
def impute_rent(t: Inputs) -> DataFrame:
    return cohort.impute_rent(t.cohorts, t.urban).select(
        "CODIGO_BARRIO", "CLASE_PREDIO", "ESTRATO", "ANO", "PRECIO_MEAN_ARRIENDO")


@query
def ratio_split(t: Inputs) -> DataFrame:
    return t.split.select("CODIGO_BARRIO", "CLASE_PREDIO", "ESTRATO", "ANO", "RATIO", "SPLIT")


@query
def rejected_rows(t: Inputs) -> DataFrame:
    return cohort.rejected_rows(t.urban, t.split).select(
        "IDENTIFICADOR", "CODIGO_BARRIO", "ANO", "CLASE_PREDIO", "ESTRATO", "PRECIO", "RATIO")


@query
def cohorts_without_rent(t: Inputs) -> DataFrame:
    return cohort.cohorts_without_rent(t.cohorts, t.urban).select(
        "CODIGO_BARRIO", "CLASE_PREDIO", "ESTRATO", "ANO", "PRECIO_MEAN_VENTA", "N_VENTA", "MEAN_ARRIENDO_LOC")


@query
def cohort_coverage(t: Inputs) -> DataFrame:
    return _doubles(cohort.cohort_coverage(t.split), "ANO", "ESTRATO")


# ---- pooling -------------------------------------------------------------------------------------------

def _counts(t: Inputs) -> DataFrame:
    return stage(pooling.sector_counts(t.urban))


@query
def seg_sector_counts(t: Inputs) -> DataFrame:
    return pooling.sector_counts(t.urban)


@query
def pool_small(t: Inputs) -> DataFrame:
    return pooling.small_sectors(pooling.sector_counts(t.urban))


@query
def pool_neighbor(t: Inputs) -> DataFrame:
    return pooling.nearest_code(_counts(t))


@query
def pool_root_round1(t: Inputs) -> DataFrame:
    return pooling.chain_roots(pooling.nearest_code(_counts(t)))


@query
def pool_assign_round1(t: Inputs) -> DataFrame:
    counts = _counts(t)
    merged = pooling.merges(counts)
    return counts.join(merged, [*SEGMENT, "code"], "left").groupBy(
        *SEGMENT, F.coalesce("root", "code").alias("pool")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("sectors"))


@query
def pool_assign(t: Inputs) -> DataFrame:
    return pooling.pool_codes(t.urban).groupBy(*SEGMENT, "CODIGO_BARRIO_NEW").agg(F.count(F.lit(1)).alias("N"))


# ---- control chart -------------------------------------------------------------------------------------

PAIR = ["PRECIO", "AREA_CONSTRUIDA"]


@query
def pool_constant_cols(t: Inputs) -> DataFrame:
    return control.constant_columns(t.urban, [*SEGMENT, "CODIGO_BARRIO"])


@query
def pool_moments(t: Inputs) -> DataFrame:
    m = control.moments(t.urban, SEGMENT)
    m = m.withColumns({"sd0": F.sqrt("var0") / 1e6, "sd1": F.sqrt("var1") / 1e6, "sd2": F.sqrt("var2"),
                       "r01": F.col("cov01") / F.sqrt(F.col("var0") * F.col("var1")),
                       "r02": F.col("cov02") / F.sqrt(F.col("var0") * F.col("var2")),
                       "r12": F.col("cov12") / F.sqrt(F.col("var1") * F.col("var2"))})
    return m.select(*SEGMENT, "n", "mean0", "mean1", "mean2", *[_rounded(c, 7) for c in (
        "sd0", "sd1", "sd2", "r01", "r02", "r12")])


@query
def pool_moments_merged(t: Inputs) -> DataFrame:
    """Segment moments put together from sector moments."""
    m = control.merge_moments(control.moments(t.urban, [*SEGMENT, "CODIGO_BARRIO"]), SEGMENT)
    m = m.withColumns({"sd0": F.sqrt("var0") / 1e6, "sd1": F.sqrt("var1") / 1e6, "sd2": F.sqrt("var2"),
                       "r01": F.col("cov01") / F.sqrt(F.col("var0") * F.col("var1")),
                       "r02": F.col("cov02") / F.sqrt(F.col("var0") * F.col("var2")),
                       "r12": F.col("cov12") / F.sqrt(F.col("var1") * F.col("var2"))})
    return m.select(*SEGMENT, "n", *[_rounded(c, 7) for c in ("sd0", "sd1", "sd2", "r01", "r02", "r12")])


@query
def t2_statistic_p2(t: Inputs) -> DataFrame:
    chart = control.t2_chart(t.urban, SEGMENT, PAIR)
    return chart.select("IDENTIFICADOR", *SEGMENT, "PRECIO", _rounded("t2", 5))


@query
def t2_statistic_p3(t: Inputs) -> DataFrame:
    chart = control.t2_chart(t.urban, SEGMENT, singular_tol=0.0)
    return chart.select("IDENTIFICADOR", *SEGMENT, "PRECIO", _rounded("t2", 5))


@query
def t2_limit_p2(t: Inputs) -> DataFrame:
    """Of every group; those of one or two rows, or without a measure that varies, have no limit."""
    stats = control.moments(t.urban, [*SEGMENT, "CODIGO_LOCALIDAD"], PAIR)
    limits = control.chart_parameters(stats, 2, singular_tol=1e-12, scaled=True)
    return limits.select(*SEGMENT, "CODIGO_LOCALIDAD", "n", "p", _rounded("ucl", 6))


@query
def t2_limit(t: Inputs) -> DataFrame:
    limits = control.chart_parameters(control.moments(t.urban, [*SEGMENT, "CODIGO_BARRIO"]))
    return limits.select(*SEGMENT, "CODIGO_BARRIO", "n", "p", "ucl")


@query
def t2_limit_scaled(t: Inputs) -> DataFrame:
    """Limits on three measures with the singularity rule on, judged on the correlation: measures that others determine leave."""
    limits = control.chart_parameters(control.moments(t.urban, [*SEGMENT, "CODIGO_LOCALIDAD"]), singular_tol=1e-12, scaled=True)
    return limits.select(*SEGMENT, "CODIGO_LOCALIDAD", "n", "p", _rounded("ucl", 6))


@query
def t2_flags_p2(t: Inputs) -> DataFrame:
    chart = control.t2_chart(t.urban, SEGMENT, PAIR)
    return chart.filter("is_outlier").select("IDENTIFICADOR", *SEGMENT, "PRECIO", "AREA_CONSTRUIDA")


@query
def chart_points(t: Inputs) -> DataFrame:
    chart = control.t2_chart(t.urban, SEGMENT, PAIR)
    order = ["IDENTIFICADOR", "PRECIO", "AREA_CONSTRUIDA"]
    return control.chart_points(chart, SEGMENT, order).select(
        *SEGMENT, "label", "IDENTIFICADOR", _rounded("t2", 5), _rounded("ucl", 5), "out")


POOL = [*SEGMENT, "CODIGO_BARRIO_NEW"]


@query
def chart_first_group(t: Inputs) -> DataFrame:
    """The chart shown as an illustration: the first pool of the first segment, on three measures."""
    first = diagnostics.first_group(stage(pooling.pool_codes(t.urban)), POOL)
    chart = control.t2_chart(first, POOL, singular_tol=0.0)
    return control.chart_points(chart, POOL, ["IDENTIFICADOR", "PRECIO", "AREA_CONSTRUIDA"]).select(
        *POOL, "label", "IDENTIFICADOR", _rounded("t2", 5), _rounded("ucl", 5), "out")


@query
def qc_pass_pools(t: Inputs) -> DataFrame:
    """A control pass by pool; no measure is dropped for a covariance that is only close to singular."""
    scored = control.control_pass(t.urban, singular_tol=0.0)
    return scored.groupBy(*POOL).agg(F.count(F.lit(1)).alias("N"), F.count_if("is_outlier").alias("OUT"),
                                     F.round(F.first("ucl"), 6).alias("UCL"))


@query
def qc_two_pass_rows(t: Inputs) -> DataFrame:
    """Rows that two passes keep, with the pool of the second."""
    return control.quality_control(t.urban, singular_tol=0.0).select(
        "IDENTIFICADOR", *POOL, "CODIGO_BARRIO", "PRECIO", "AREA_CONSTRUIDA")


@query
def qc_pass(t: Inputs) -> DataFrame:
    scored = control.control_pass(t.study.cleaned_once, weight=clean.COPIES)
    return scored.groupBy(*SEGMENT, "CODIGO_BARRIO_NEW").agg(
        F.sum(clean.COPIES).alias("N"), F.sum(F.when(F.col("is_outlier"), F.col(clean.COPIES)).otherwise(0)).alias("OUT"),
        F.first("ucl").alias("UCL"))


@query
def qc_two_pass(t: Inputs) -> DataFrame:
    return t.study.kept


# ---- models --------------------------------------------------------------------------------------------

def _origin(rows: DataFrame) -> design.SlopeModel:
    return design.slope_model(rows, ())


def _one_factor(rows: DataFrame) -> design.SlopeModel:
    return design.slope_model(rows, ("ESTRATO",))


KEYS = ["CLASE_PREDIO", "CODIGO_BARRIO", "ESTRATO", "ANO"]


@query
def onehot(t: Inputs) -> DataFrame:
    """One column per level of either class; a level that a class lacks is 0 there."""
    def indicators(rows: DataFrame) -> DataFrame:
        model = design.slope_model(rows)
        return design.with_indicators(rows, model).select(
            "CODIGO_BARRIO", "ESTRATO", "ANO", *[f"{f}{v}" for f, v in model.terms[1:]])

    return _by_class(t, indicators).fillna(0)


@query
def ols_origin_p1(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: ols.ols_coefficients(rows, ols.fit_ols(rows, _origin(rows)))).select(
        "CLASE_PREDIO", "FACTOR", "NIVEL", _rounded("COEF", 6))


@query
def ols_one_factor(t: Inputs) -> DataFrame:
    """A slope per stratum: the base's, and each other stratum's difference from it."""
    return _by_class(t, lambda rows: ols.ols_coefficients(rows, ols.fit_ols(rows, _one_factor(rows)))).select(
        "CLASE_PREDIO", "FACTOR", "NIVEL", _rounded("COEF", 6))


@query
def ols_normal_equations(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: ols.normal_equations(rows, ols.fit_ols(rows, design.slope_model(rows)))).select(
        "CLASE_PREDIO", "FACTOR", "NIVEL", _rounded("RELATIVE", 8))


@query
def ols_coefs(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: ols.ols_coefficients(rows, ols.fit_ols(rows, design.slope_model(rows))))


def _influence(t: Inputs, model: Callable[[DataFrame], design.SlopeModel]) -> DataFrame:
    return _by_class(t, lambda rows: ols.with_influence(rows, ols.fit_ols(rows, model(rows))))


@query
def cook_p1(t: Inputs) -> DataFrame:
    return _influence(t, _origin).select(*KEYS, _rounded("hat", 9), _rounded("cook", 9))


@query
def dfbetas_p1(t: Inputs) -> DataFrame:
    return _influence(t, _origin).select(*KEYS, _rounded("dfbetas_max", 8))


@query
def influence_one_factor(t: Inputs) -> DataFrame:
    return _influence(t, _one_factor).select(
        *KEYS, *[_rounded(c, 7) for c in ("hat", "cook", "dfbetas_min", "dfbetas_max")])


@query
def prune_one_factor(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: ols.prune_influential(rows, _one_factor(rows))).select(
        *KEYS, "PRECIO_MEAN_ARRIENDO", "PRECIO_MEAN_VENTA")


@query
def cook(t: Inputs) -> DataFrame:
    return _influence(t, design.slope_model).select(*KEYS, "hat", "cook", "dfbetas_min", "dfbetas_max")


@query
def prune(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: ols.prune_influential(rows, design.slope_model(rows)))


# theta values of the profile queries
THETAS = [0.0, 1e-12, 1e-11, 1e-10, 1e-9, 1e-8]
BLUP_THETA = 1e-10


@query
def lmm_profile_p1(t: Inputs) -> DataFrame:
    table = _by_class(t, lambda rows: mixed.profile_table(rows, _origin(rows), "CODIGO_BARRIO", THETAS))
    return table.select("CLASE_PREDIO", "THETA", _rounded("LOGLIK", 5),
                        (F.round(F.col("SIGMA2") / 1e9, 6)).alias("SIGMA2"))


def _fit_p1(rows: DataFrame) -> mixed.MixedFit:
    return mixed.fit_at(rows, _origin(rows), BLUP_THETA)


@query
def lmm_blup_p1(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: _fit_p1(rows).ranef).select(
        "CLASE_PREDIO", "CODIGO_BARRIO", _rounded("RAN_EFFECT", 6))


@query
def lmm_fixed_p1(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: _fit_p1(rows).coefs).select(
        "CLASE_PREDIO", "FACTOR", "NIVEL", _rounded("COEF", 6))


def _residuals_p1(t: Inputs) -> DataFrame:
    return _by_class(t, lambda rows: mixed.with_fitted(rows, _fit_p1(rows)))


@query
def lmm_residuals_p1(t: Inputs) -> DataFrame:
    return _residuals_p1(t).select(*KEYS, _rounded("Fitted", 3), _rounded("Residuals", 3))


@query
def lmm_residual_boxplot_p1(t: Inputs) -> DataFrame:
    box = diagnostics.five_numbers(_residuals_p1(t), "Residuals", ["CLASE_PREDIO", "ESTRATO", "ANO"])
    return box.select("CLASE_PREDIO", "ESTRATO", "ANO", *[
        _rounded(c, 3) for c in ("MINIMO", "Q1", "MEDIANA", "Q3", "MAXIMO")])


@query
def lmm_residual_histogram_p1(t: Inputs) -> DataFrame:
    return diagnostics.histogram(stage(_residuals_p1(t)), "Residuals").select("BIN", "N")


@query
def lmm_random_histogram_p1(t: Inputs) -> DataFrame:
    effects = stage(_by_class(t, lambda rows: _fit_p1(rows).ranef))
    return diagnostics.histogram(effects, "RAN_EFFECT").select("BIN", "N")


def _nested(t: Inputs, make: Callable[[str, list[mixed.MixedFit]], DataFrame]) -> DataFrame:
    """``make`` of the nested fits of the whole model, by both methods, on the cohorts of each class."""
    return _by_class(t, lambda rows: _labelled_methods(rows, make))


def _labelled_methods(rows: DataFrame, make) -> DataFrame:
    model = design.slope_model(rows)
    made = [make(m, mixed.fit_nested(rows, model, method=m)).withColumn("METHOD", F.lit(m)) for m in ("REML", "ML")]
    return made[0].unionByName(made[1])


@query
def lmm_search(t: Inputs) -> DataFrame:
    """What the search for the variance ratio finds for each of the nested models, by REML and ML."""
    def found(method: str, fits: list[mixed.MixedFit]) -> DataFrame:
        rows = [(k, float(f.theta), float(f.sigma2), float(f.loglik), f.p) for k, f in enumerate(fits, 1)]
        return t.spark.createDataFrame(rows, "Model int, theta double, SIGMA2 double, LOGLIK double, P int")

    return _nested(t, found).select(
        "CLASE_PREDIO", "METHOD", "Model", "P", F.round(F.when(F.col("theta") > 0, F.log("theta")), 3).alias("LOG_THETA"),
        F.round(F.col("SIGMA2") / 1e9, 2).alias("SIGMA2"), _rounded("LOGLIK", 5))


@query
def lmm_nested_anova(t: Inputs) -> DataFrame:
    """The likelihood-ratio table of the nested models, by REML as published and by ML, whose comparison is valid."""
    return _nested(t, lambda method, fits: mixed.anova(t.spark, fits)).select(
        "CLASE_PREDIO", "METHOD", "Model", "df", *[_rounded(c, 4) for c in ("AIC", "BIC", "logLik", "L_Ratio")])


@query
def lmm_whole_fixed(t: Inputs) -> DataFrame:
    """Coefficients of the whole model with the variance ratio that the search finds."""
    return _nested(t, lambda method, fits: fits[-1].coefs).select(
        "CLASE_PREDIO", "METHOD", "FACTOR", "NIVEL", _rounded("COEF", 3))


@query
def lmm_whole_random(t: Inputs) -> DataFrame:
    """Random slopes of the whole model with the variance ratio that the search finds."""
    return _nested(t, lambda method, fits: fits[-1].ranef).select(
        "CLASE_PREDIO", "METHOD", "CODIGO_BARRIO", _rounded("RAN_EFFECT", 3))


@query
def lmm_fixed(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: c.fit.coefs)


@query
def lmm_random(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: c.fit.ranef)


@query
def lmm_anova(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: c.anova)


@query
def lmm_residuals(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: c.residuals).select(
        *KEYS, "PRECIO_MEAN_ARRIENDO", "PRECIO_MEAN_VENTA", "Fitted", "Residuals")


@query
def lmm_residual_boxplot(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: diagnostics.five_numbers(c.residuals, "Residuals", ["ESTRATO", "ANO"]))


@query
def lmm_residual_histogram(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: diagnostics.histogram(c.residuals, "Residuals"))


@query
def lmm_random_histogram(t: Inputs) -> DataFrame:
    return _study_by_class(t, lambda c: diagnostics.histogram(c.fit.ranef, "RAN_EFFECT"))


@query
def coef_terms(t: Inputs) -> DataFrame:
    base = F.lit("PRECIO_MEAN_ARRIENDO")
    labels = t.offers.select(F.explode(F.array(
        base, F.concat(base, F.lit(":ESTRATO"), F.col("ESTRATO")), F.concat(base, F.lit(":ANO"), F.col("ANO")),
        F.concat(base, F.lit(":CODIGO_LOCALIDAD"), F.col("CODIGO_LOCALIDAD")))).alias("rowname")).distinct()
    return design.parse_terms(labels).withColumn("Intercepto", F.coalesce("Intercepto", F.lit(0)))


@query
def diag_histogram(t: Inputs) -> DataFrame:
    return diagnostics.histogram(t.urban, "VALOR_M2_INTEGRAL").select("BIN", "N")


@query
def diag_boxplot(t: Inputs) -> DataFrame:
    return diagnostics.five_numbers(t.urban, "VALOR_M2_INTEGRAL", ["ESTRATO", "ANO"])


@query
def diag_boxplot_narrowed(t: Inputs) -> DataFrame:
    """Five numbers; the quantiles have one path for groups of any size."""
    return diagnostics.five_numbers(t.urban, "VALOR_M2_INTEGRAL", ["ESTRATO", "ANO"])


@query
def line_by_group(t: Inputs) -> DataFrame:
    fit = diagnostics.line_fit(t.split, "PRECIO_MEAN_VENTA", "PRECIO_MEAN_ARRIENDO", ["ESTRATO", "ANO"])
    return fit.select("ESTRATO", "ANO", _rounded("PENDIENTE", 6),
                      F.round(F.col("INTERCEPTO") / 1000, 6).alias("INTERCEPTO"), "N")


# ---- rates ---------------------------------------------------------------------------------------------

@query
def rates_sector(t: Inputs) -> DataFrame:
    return t.fixed_rates


@query
def rates_stratum(t: Inputs) -> DataFrame:
    return rates.rates_by_stratum(t.fixed_rates)


@query
def rates_low_strata(t: Inputs) -> DataFrame:
    return rates.only_strata(rates.rates_by_stratum(t.fixed_rates), [1, 2, 3])


@query
def rates_locality(t: Inputs) -> DataFrame:
    return rates.rates_by_locality(t.fixed_rates)


@query
def rates_locality_named(t: Inputs) -> DataFrame:
    return rates.with_locality_names(rates.rates_by_locality(t.fixed_rates), t.locality)


@query
def rates_report(t: Inputs) -> DataFrame:
    report = rates.report_rates(rates.rates_by_stratum(t.fixed_rates))
    return report.withColumn("TASA_PORCENTAJE", F.round("TASA_PORCENTAJE", 3))


@query
def rates_published(t: Inputs) -> DataFrame:
    return rates.published_sector_rates(t.fixed_rates)


def _read_back(t: Inputs, level: str) -> DataFrame:
    """Publish the rates twice and read a level."""
    path = Store(t.spark, "rates").path("published")
    both = [f(t.fixed_rates).withColumn("CLASE_PREDIO", F.lit("P"))
            for f in (rates.published_sector_rates, rates.published_locality_rates)]
    for _ in range(2):
        tables.publish_rates(*map(stage, both), path)
    return tables.read_published(t.spark, path, level)


@query
def rates_sector_read_back(t: Inputs) -> DataFrame:
    return _read_back(t, "sectores")


@query
def rates_locality_read_back(t: Inputs) -> DataFrame:
    return _read_back(t, "localidades")


def _ordered(t: Inputs, table: DataFrame, order: list[str]) -> DataFrame:
    """Publish a table in an order, prove the order of its files, and read it with its rank."""
    made = Publication(t.spark, Store(t.spark, "ordered").path("published"))
    made.write({"tabla": Ordered(stage(table), tuple(order))})
    made.check()
    return made.read("tabla")


@query
def rates_sector_ordered(t: Inputs) -> DataFrame:
    return _ordered(t, t.fixed_rates, ["TASA_RENTA"])


@query
def rates_stratum_ordered(t: Inputs) -> DataFrame:
    return _ordered(t, rates.rates_by_stratum(t.fixed_rates), rates.STRATUM_ORDER)


@query
def rates_locality_ordered(t: Inputs) -> DataFrame:
    return _ordered(t, rates.rates_by_locality(t.fixed_rates), rates.LOCALITY_ORDER)


@query
def rates_published_ordered(t: Inputs) -> DataFrame:
    return _ordered(t, rates.published_locality_rates(t.fixed_rates), rates.PUBLISHED_ORDER)


@query
def cohorts_reloaded(t: Inputs) -> DataFrame:
    """Cohorts made as named steps, and loaded by name from a session that did not make them."""
    root = Store(t.spark, "steps").path("catalogue")
    steps = Steps(t.spark, root)
    urban = steps.run("urban", _urban, steps.source(t.listings))
    steps.run("cohorts", cohort.cohort_table, urban)
    return _doubles(Steps(t.spark.newSession(), root).load("cohorts"), *N_COLUMNS)


def _urban(listings: DataFrame) -> DataFrame:
    return clean.parsed_listings(clean.exclusions(clean.only_homes(listings)))


@query
def clean_rows_read_back(t: Inputs) -> DataFrame:
    """Cleaned listings written as a table and read again."""
    path = Store(t.spark, "clean").path("tables")
    tables.write_tables({"DEPURADA": t.urban}, path)
    return t.spark.read.parquet(f"{path}/DEPURADA").groupBy(*SEGMENT).agg(
        F.count(F.lit(1)).alias("N"), F.sum("VALOR_M2_INTEGRAL").alias("TOTAL"))


@query
def distinct_rates(t: Inputs) -> DataFrame:
    return rates.published_locality_rates(t.fixed_rates)


@query
def study_sector_rates(t: Inputs) -> DataFrame:
    return t.study.sector_rates


@query
def study_locality_rates(t: Inputs) -> DataFrame:
    return t.study.locality_rates


# ---- validation ----------------------------------------------------------------------------------------

@query
def val_rates_union(t: Inputs) -> DataFrame:
    r = t.fixed_rates
    return rates.union_classes(rates.published_sector_rates(r), rates.published_sector_rates(r))


@query
def val_join_rates(t: Inputs) -> DataFrame:
    joined = validate.join_rates(t.two_price, t.rates_sector, t.rates_locality)
    return joined.select("OFT_CODIGO", "TASA_SECTOR", "TASA_LOCALIDAD")


@query
def val_rate_choice(t: Inputs) -> DataFrame:
    joined = validate.join_rates(t.two_price, t.rates_sector, t.rates_locality)
    return validate.choose_rate(joined).select("OFT_CODIGO", "TCR_ESTADISTICA")


@query
def val_plausible(t: Inputs) -> DataFrame:
    return validate.plausible(t.two_price).select("OFT_CODIGO", "TCR_OIC")


@query
def val_estimate(t: Inputs) -> DataFrame:
    return t.validated.select("OFT_CODIGO", "VR_INICIAL_ARRIENDO", "TCR_ESTADISTICA", "TCR_OIC", "VENTA_ESTIMADA")


@query
def val_errors(t: Inputs) -> DataFrame:
    return t.validated.select("OFT_CODIGO", "DIFERENCIAS", "DIFERENCIAS_TCR")


@query
def val_tables_read_back(t: Inputs) -> DataFrame:
    """The validation's base and its four summaries written as tables; the summaries read again."""
    path = Store(t.spark, "validation").path("tables")
    made = validate.validation_tables(stage(t.validated))
    tables.write_tables(made, path)
    found = [t.spark.read.parquet(f"{path}/{name}").withColumn("NIVEL", F.lit(name)) for name in made if name != "BASE_FINAL"]
    summary = reduce(DataFrame.unionByName, found)
    return _doubles(summary, "CODIGO_ESTRATO_SIIC").withColumns({
        "ERROR_TOTAL_MEDIO": F.round("ERROR_TOTAL_MEDIO", 3), "DIF_TCR": F.round("DIF_TCR", 9)})


@query
def val_summary_grouping_sets(t: Inputs) -> DataFrame:
    summary = validate.validation_summary(stage(t.validated))
    return _doubles(summary, "CODIGO_ESTRATO_SIIC").select(
        "NIVEL", "OFT_TIPO_INMUEBLE", "NOMBRE_LOCALIDAD", "CODIGO_ESTRATO_SIIC", "NUM_PREDIOS",
        _rounded("ERROR_TOTAL_MEDIO", 3), _rounded("DIF_TCR", 9))


@query
def val_summary_narrowed(t: Inputs) -> DataFrame:
    """The validation summary; its medians have one path for groups of any size."""
    summary = validate.validation_summary(stage(t.validated))
    return _doubles(summary, "CODIGO_ESTRATO_SIIC").select(
        "NIVEL", "OFT_TIPO_INMUEBLE", "NOMBRE_LOCALIDAD", "CODIGO_ESTRATO_SIIC", "NUM_PREDIOS",
        _rounded("ERROR_TOTAL_MEDIO", 3), _rounded("DIF_TCR", 9))


@query
def val_error_bands(t: Inputs) -> DataFrame:
    # errors are scaled up so that every band is used
    return validate.error_bands(t.validated.withColumn("DIFERENCIAS", F.col("DIFERENCIAS") * 8))


@query
def val_error_quantiles(t: Inputs) -> DataFrame:
    return validate.error_quantiles(stage(t.validated)).select("PROB", _rounded("MILLONES", 8))


@query
def val_corr(t: Inputs) -> DataFrame:
    return validate.price_correlation(t.validated).select(_rounded("CORR", 9))


@query
def second_sample_unpivot(t: Inputs) -> DataFrame:
    return validate.unpivot_prices(t.two_price).select("OFT_CODIGO", "TIPO_OFERTA", "PRECIO")


@query
def second_sample_union(t: Inputs) -> DataFrame:
    return validate.union_samples(t.two_price, t.urban).select(
        "IDENTIFICADOR", "TIPO_OFERTA", "PRECIO", "VALOR_M2_INTEGRAL", "AREA_CONSTRUIDA", "ESTRATO", "ANO",
        "CLASE_PREDIO", "BARMANPRE", "MARCA")


def _survivors(t: Inputs) -> DataFrame:
    """Rows of both samples that two passes of the control keep, each once with its copies."""
    sample = clean.clean_once(validate.union_samples(t.two_price, t.urban), t.fee_census)
    return control.quality_control(sample, singular_tol=0.0, weight=clean.COPIES)


@query
def second_sample_semi(t: Inputs) -> DataFrame:
    return validate.keep_survivors(t.two_price, _survivors(t)).select("OFT_CODIGO", "VIGENCIA", "CODIGO_BARRIO")


@query
def survivors_read_back(t: Inputs) -> DataFrame:
    """Properties of the second sample that survive the control, written as a table and read again."""
    path = Store(t.spark, "survivors").path("tables")
    tables.write_tables({"SOBREVIVIENTES": validate.keep_survivors(t.two_price, _survivors(t))}, path)
    return t.spark.read.parquet(f"{path}/SOBREVIVIENTES")


@query
def second_sample_inner(t: Inputs) -> DataFrame:
    return validate.keep_survivors(t.two_price, _survivors(t), repeat=True).select(
        "OFT_CODIGO", "VIGENCIA", "CODIGO_BARRIO")


@query
def second_sample_qc(t: Inputs) -> DataFrame:
    return validate.screen_second_sample(t.two_price, t.study.cleaned_once, t.fee_census)
