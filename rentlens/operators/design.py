"""The varying-slope design: sale on rent, with a slope per level of each factor and treatment contrasts.

Every column of the design is rent times a 0/1 indicator, so all cross products are sums of rent^2, rent*sale
and sale^2 over factor levels and pairs of levels. The design matrix itself is never built.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# short names of the factors in coefficient tables
FACTOR_NAMES = {"ESTRATO": "est", "CODIGO_LOCALIDAD": "loc", "ANO": "year"}


@dataclass(frozen=True)
class SlopeModel:
    """Response, slope variable and ordered factor levels; the first level of a factor is its base."""

    levels: dict[str, list]
    response: str = "PRECIO_MEAN_VENTA"
    slope: str = "PRECIO_MEAN_ARRIENDO"

    @property
    def factors(self) -> list[str]:
        return list(self.levels)

    @property
    def terms(self) -> list[tuple[str, object]]:
        """(factor, level) in design order; the common slope comes first."""
        return [("all", None), *[(f, v) for f in self.factors for v in self.levels[f][1:]]]

    def restricted(self, factors: list[str]) -> "SlopeModel":
        return replace(self, levels={f: self.levels[f] for f in factors})

    def rows(self, df: DataFrame) -> DataFrame:
        """Complete rows only."""
        return df.dropna(subset=[self.response, self.slope, *self.factors])


def slope_model(df: DataFrame, factors: tuple[str, ...] = ("ESTRATO", "CODIGO_LOCALIDAD", "ANO"),
                response: str = "PRECIO_MEAN_VENTA", slope: str = "PRECIO_MEAN_ARRIENDO") -> SlopeModel:
    """Levels from the data, ascending (text in string order). Each is a column of the model, whose products are solved
    on the driver, so a factor of a million levels asks for a driver of that size; none is left out."""
    levels: dict[str, list] = {f: [] for f in factors}
    if factors:
        flags = [F.grouping(f).alias(f"all_{f}") for f in factors]
        found = df.groupingSets([[f] for f in factors], *factors).agg(*flags).collect()
        for r in found:
            for f in factors:
                if not r[f"all_{f}"] and r[f] is not None:
                    levels[f].append(r[f])
    return SlopeModel({f: sorted(v) for f, v in levels.items()}, response, slope)


def with_indicators(df: DataFrame, model: SlopeModel) -> DataFrame:
    """One 0/1 column per non-base level, named factor + level."""
    return df.withColumns({f"{f}{v}": F.when(F.col(f) == v, 1).otherwise(0) for f, v in model.terms[1:]})


def cross_products(df: DataFrame, model: SlopeModel) -> tuple[np.ndarray, int]:
    """[X y]'[X y] and the row count, from one grouping-sets aggregate (at most one row per matrix entry)."""
    x, y = F.col(model.slope), F.col(model.response)
    sums = [F.sum(x * x).alias("xx"), F.sum(x * y).alias("xy"), F.sum(y * y).alias("yy"),
            F.count(F.lit(1)).alias("n")]
    rows, factors = model.rows(df), model.factors
    if factors:
        sets = [[], *[[f] for f in factors], *[list(c) for c in combinations(factors, 2)]]
        flags = [F.grouping(f).alias(f"all_{f}") for f in factors]
        found = rows.groupingSets(sets, *factors).agg(*flags, *sums).collect()
    else:
        found = rows.agg(*sums).collect()
    where = {t: i for i, t in enumerate(model.terms)}
    last = len(where)
    gram, n = np.zeros((last + 1, last + 1)), 0
    for r in found:
        used = [(f, r[f]) for f in factors if not r[f"all_{f}"]]
        if any(t not in where for t in used):
            continue  # a base level has no column of its own
        if not used:
            n = r["n"]
            gram[0, 0], gram[0, last], gram[last, last] = r["xx"] or 0.0, r["xy"] or 0.0, r["yy"] or 0.0
        elif len(used) == 1:
            i = where[used[0]]
            gram[0, i] = gram[i, i] = r["xx"]
            gram[i, last] = r["xy"]
        else:
            i, j = sorted((where[used[0]], where[used[1]]))
            gram[i, j] = r["xx"]
    return np.triu(gram) + np.triu(gram, 1).T, n


def independent_columns(a: np.ndarray, tol: float = 1e-10) -> list[int]:
    """Columns of a Gram matrix that are not a combination of earlier ones."""
    # a Cholesky factor that grows by a row for each column kept: one triangular step per column, no solve
    rows = np.zeros_like(a)  # row k: the k-th kept column's part of every column
    rest = np.diag(a).astype(float).copy()
    kept: list[int] = []
    for j in range(len(a)):
        if a[j, j] <= 0 or rest[j] <= tol * a[j, j]:
            continue
        k = len(kept)
        rows[k] = (a[j] - rows[:k, j] @ rows[:k]) / np.sqrt(rest[j])
        rest -= rows[k] ** 2
        kept.append(j)
    return kept


def coefficient_table(spark: SparkSession, model: SlopeModel, beta: np.ndarray) -> DataFrame:
    """(FACTOR, NIVEL, COEF); a coefficient that cannot be estimated is null."""
    rows = [(FACTOR_NAMES.get(f, f), "" if v is None else str(v), None if np.isnan(b) else float(b))
            for (f, v), b in zip(model.terms, beta)]
    return spark.createDataFrame(rows, "FACTOR string, NIVEL string, COEF double")


def parse_terms(df: DataFrame, term: str = "rowname") -> DataFrame:
    """Stratum, locality, year and common-slope flag from a term label such as ``...:ESTRATO4``."""
    def level(name: str):
        found = F.regexp_extract(term, rf"{name}(\d+)", 1)
        return F.when(found != "", found)

    return df.withColumns({
        "ESTRATO": F.regexp_extract(term, r"ESTRATO(\d)", 1), "CODIGO_LOCALIDAD": level("CODIGO_LOCALIDAD"),
        "ANO": level("ANO"), "Intercepto": F.when(F.col(term) == "PRECIO_MEAN_ARRIENDO", 1)}).withColumn(
            "ESTRATO", F.when(F.col("ESTRATO") != "", F.col("ESTRATO")))
