"""The whole study: listings to rate tables, each step a stage table that is built once and read by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.clean import COPIES, clean_once, only_homes, with_each_fee
from rentlens.operators.cohort import cohort_table, impute_cohorts, split_by_ratio
from rentlens.operators.control import quality_control
from rentlens.operators.design import slope_model
from rentlens.operators.mixed import MixedFit, anova, fit_nested, with_fitted
from rentlens.operators.ols import prune_influential
from rentlens.operators.rates import (LOCALITY_ORDER, STRATUM_ORDER, published_locality_rates, published_sector_rates,
                                      rate_table, rates_by_locality, rates_by_stratum)
from rentlens.operators.validate import SUMMARY_KEYS, apply_rates, screen_second_sample, validation_tables
from rentlens.sources.publication import Ordered, Publication
from rentlens.sources.steps import Steps, Table
from rentlens.sources.store import Store
from rentlens.sources.tables import publish_rates


def class_cohorts(split: DataFrame, kind: str) -> DataFrame:
    """Cohorts of one class whose ratio lies in the window."""
    return split.filter((F.col("SPLIT") == "in") & (F.col("CLASE_PREDIO") == kind))


def clean(listings: DataFrame, fee_census: DataFrame, save: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    return clean_once(only_homes(listings), fee_census, save=save)


def prune(cohorts: DataFrame) -> DataFrame:
    return prune_influential(cohorts, slope_model(cohorts))


#: steps that hold each listing once, by the attribute they are read from inside the study
ONCE = {"cleaned": "cleaned_once", "kept": "kept_once"}


class ClassStudy:
    """Model and rates of one property class (P: apartments, N: houses)."""

    def __init__(self, study: "Study", kind: str):
        self.study, self.kind = study, kind

    def _step(self, name: str, make, *inputs: str, **options) -> DataFrame:
        own = [f"{i}_{self.kind}" if i in vars(ClassStudy) else i for i in inputs]
        return self.study.step(f"{name}_{self.kind}", make, *own, **options)

    @cached_property
    def cohorts(self) -> DataFrame:
        return self._step("cohorts", class_cohorts, "split", kind=self.kind)

    @cached_property
    def pruned(self) -> DataFrame:
        return self._step("pruned", prune, "cohorts")

    @cached_property
    def fits(self) -> list[MixedFit]:
        return fit_nested(self.pruned, slope_model(self.pruned))

    @property
    def fit(self) -> MixedFit:
        return self.fits[-1]

    # what the fits give is stored, so that a session which finds it does not fit
    @cached_property
    def coefs(self) -> DataFrame:
        return self._step("coefs", lambda pruned: self.fit.coefs, "pruned", code=(fit_nested, slope_model))

    @cached_property
    def ranef(self) -> DataFrame:
        return self._step("ranef", lambda pruned: self.fit.ranef, "pruned", code=(fit_nested, slope_model))

    @cached_property
    def anova(self) -> DataFrame:
        return self._step("anova", lambda pruned: anova(pruned.sparkSession, self.fits), "pruned",
                          code=(anova, fit_nested, slope_model))

    @cached_property
    def residuals(self) -> DataFrame:
        return self._step("residuals", lambda pruned: with_fitted(pruned, self.fit), "pruned",
                          code=(with_fitted, fit_nested, slope_model))

    @cached_property
    def rates(self) -> DataFrame:
        return self._step("rates", rate_table, "pruned", "coefs", "ranef")

    @cached_property
    def by_stratum(self) -> DataFrame:
        return rates_by_stratum(self.rates)

    @cached_property
    def by_locality(self) -> DataFrame:
        return rates_by_locality(self.rates)


class Study:
    """Steps are computed on first use and kept in a store of their own, or in ``steps``, where other sessions find them."""

    def __init__(self, listings: DataFrame, fee_census: DataFrame, cadastral: DataFrame, steps: Steps | None = None):
        self.listings, self.fee_census, self.cadastral = listings, fee_census, cadastral
        self.store, self.steps = Store(listings.sparkSession, "study"), steps
        self.classes = {kind: ClassStudy(self, kind) for kind in ("P", "N")}
        self._tables: dict[str, Table] = {}

    def _frame(self, name: str) -> DataFrame:
        """A source or a step, by its name; steps of a class end in its letter."""
        if name == "kept" and self.steps is None and "kept_once" not in vars(self):
            return self.controlled  # read for a few columns: rows are stored where they are asked for
        name = ONCE.get(name, name)
        if name in vars(Study) or name in vars(self):
            return getattr(self, name)
        short, _, kind = name.rpartition("_")
        return getattr(self.classes[kind], short)

    def _table(self, name: str) -> Table:
        frame = self._frame(name)  # a step enters its table
        if name not in self._tables:
            self._tables[name] = self.steps.source(frame)
        return self._tables[name]

    def step(self, name: str, make, *inputs: str, code: tuple = (), **parameters) -> DataFrame:
        if self.steps is None:
            return self.store.save(make(*[self._frame(i) for i in inputs], **parameters), name)
        table = self.steps.run(name, make, *[self._table(i) for i in inputs], code=code, **parameters)
        self._tables[name] = table
        return table.frame

    @cached_property
    def cleaned_once(self) -> DataFrame:
        if self.steps is None:  # stored once, by the cleaning itself
            return clean(self.listings, self.fee_census, lambda rows, label: self.store.save(rows, "cleaned"))
        return self.step("cleaned", clean, "listings", "fee_census")

    @cached_property
    def controlled(self) -> DataFrame:
        """The listings that the control keeps, as a view of the cleaned ones and the stored limits."""
        return quality_control(self.cleaned_once, weight=COPIES)

    @cached_property
    def kept_once(self) -> DataFrame:
        if self.steps is None:
            return self.store.save(self.controlled, "kept")
        return self.step("kept", quality_control, "cleaned", weight=COPIES)

    # a listing stands for a row per fee of its lot; the rows are made where they are asked for
    @cached_property
    def cleaned(self) -> DataFrame:
        return with_each_fee(self.cleaned_once, self.fee_census)

    @cached_property
    def kept(self) -> DataFrame:
        return with_each_fee(self.kept_once, self.fee_census)

    @cached_property
    def cohorts(self) -> DataFrame:
        return self.step("cohorts", cohort_table, "kept", weight=COPIES)

    @cached_property
    def imputed(self) -> DataFrame:
        return self.step("imputed", impute_cohorts, "cohorts", "kept", "cadastral", weight=COPIES)

    @cached_property
    def split(self) -> DataFrame:
        return self.step("split", split_by_ratio, "imputed")

    def _both(self, table) -> DataFrame:
        parts = [table(c).withColumn("CLASE_PREDIO", F.lit(kind)) for kind, c in self.classes.items()]
        return parts[0].unionByName(parts[1])

    @cached_property
    def sector_rates(self) -> DataFrame:
        return self._both(lambda c: published_sector_rates(c.rates))

    @cached_property
    def locality_rates(self) -> DataFrame:
        return self._both(lambda c: published_locality_rates(c.rates))

    def publish(self, path: str) -> int:
        """All rate tables as the next version of the publication in ``path``; the number of the version."""
        strata, places = (self._both(f).withColumnRenamed("CLASE_PREDIO", "CLASE")
                          for f in (lambda c: c.by_stratum, lambda c: c.by_locality))
        return publish_rates(self.sector_rates, self.locality_rates, path,
                             estratos=Ordered(strata, ("CLASE", *STRATUM_ORDER)),
                             resumen_localidades=Ordered(places, ("CLASE", *LOCALITY_ORDER)))

    def validated(self, two_price: DataFrame) -> DataFrame:
        """Listings with both prices next to what the published rates say of them."""
        both = {"P": "APARTAMENTO", "N": "CASA"}
        kind = F.create_map(*[F.lit(v) for pair in both.items() for v in pair])[F.col("CLASE_PREDIO")]
        sector, locality = (rates.withColumn("OFT_TIPO_INMUEBLE", kind).drop("CLASE_PREDIO")
                            for rates in (self.sector_rates, self.locality_rates))
        locality = locality.withColumn("CODIGO_LOCALIDAD", F.col("CODIGO_LOCALIDAD").cast("string"))
        return apply_rates(two_price, sector, locality, self.fee_census)

    def write(self, two_price: DataFrame, path: str) -> int:
        """The cleaned listings, the validation's base and summaries, and the second sample's survivors, as the next version
        of the publication in ``path``; the number of the version."""
        checked = self.store.save(self.validated(two_price), f"validated-{uuid.uuid4().hex}")
        survivors = screen_second_sample(two_price, self.cleaned_once, self.fee_census)
        made = {name: table if name == "BASE_FINAL" else Ordered(table, tuple(SUMMARY_KEYS))
                for name, table in validation_tables(checked).items()}
        publication = Publication(two_price.sparkSession, path)
        return publication.write({"DEPURADA": self.cleaned, **made, "SOBREVIVIENTES": survivors})

    def close(self) -> None:
        """Remove the steps of the study's own store. Its tables cannot be read afterwards; what was published stays, and so
        do the steps of a shared catalogue."""
        self.store.remove()
