"""Least squares on cross products, and pruning of influential rows by Cook's distance and DFBETAS."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators import design
from rentlens.operators.design import SlopeModel, coefficient_table, cross_products, independent_columns
from rentlens.sources.store import stage

# workers need not have this package installed
cloudpickle.register_pickle_by_value(design)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class OlsFit:
    model: SlopeModel
    beta: np.ndarray       # nan where a column is a combination of earlier ones
    inverse: np.ndarray    # inverse of X'X over the kept columns
    kept: list[int]
    n: int

    @property
    def rank(self) -> int:
        return len(self.kept)


def fit_ols(df: DataFrame, model: SlopeModel) -> OlsFit:
    gram, n = cross_products(df, model)
    a, b = gram[:-1, :-1], gram[:-1, -1]
    kept = independent_columns(a)
    inverse = np.linalg.inv(a[np.ix_(kept, kept)])
    beta = np.full(len(a), np.nan)
    beta[kept] = np.linalg.solve(a[np.ix_(kept, kept)], b[kept])
    return OlsFit(model, beta, inverse, kept, n)


def ols_coefficients(df: DataFrame, fit: OlsFit) -> DataFrame:
    return coefficient_table(df.sparkSession, fit.model, fit.beta)


def _cell_values(cells: pd.DataFrame, fit: OlsFit) -> pd.DataFrame:
    """Slope, leverage per rent^2, and extreme scaled rows of the inverse, per combination of levels."""
    where = {t: i for i, t in enumerate(fit.model.terms)}
    d = np.zeros((len(cells), len(where)))
    d[:, 0] = 1.0
    for f in fit.model.factors:
        column = cells[f].map(lambda v, f=f: where.get((f, v), -1)).to_numpy(dtype=int)
        has = column >= 0
        d[np.flatnonzero(has), column[has]] = 1.0
    a = d[:, fit.kept] @ fit.inverse
    b = a / np.sqrt(np.diag(fit.inverse))
    return cells.assign(slope_fit=d @ np.nan_to_num(fit.beta), leverage=(a * d[:, fit.kept]).sum(axis=1),
                        b_min=b.min(axis=1), b_max=b.max(axis=1))


def _cells(df: DataFrame, fit: OlsFit) -> DataFrame:
    """The cell values as a table. Catalyst knows its size and broadcasts it when that is small enough."""
    model = fit.model
    schema = T.StructType([*[T.StructField(f, df.schema[f].dataType) for f in model.factors],
                           *[T.StructField(c, T.DoubleType()) for c in ("slope_fit", "leverage", "b_min", "b_max")]])

    def batches(frames):
        for frame in frames:
            yield _cell_values(frame, fit)

    return stage(df.select(*model.factors).distinct().mapInPandas(batches, schema), "cells")


def with_influence(df: DataFrame, fit: OlsFit) -> DataFrame:
    """Residual, leverage, Cook's distance and the extreme DFBETAS of every complete row."""
    model = fit.model
    x, y, p, n = F.col(model.slope), F.col(model.response), fit.rank, fit.n
    rows = model.rows(df)
    if model.factors:
        rows = rows.join(_cells(df, fit), model.factors)
    else:  # one cell, and no column to make a table of
        only = _cell_values(pd.DataFrame(index=[0]), fit).iloc[0]
        rows = rows.withColumns({c: F.lit(float(v)) for c, v in only.items()})
    rows = rows.withColumn("residual", y - x * F.col("slope_fit")).withColumn("hat", x * x * F.col("leverage"))
    # a row that fixes its own fitted value has no influence measures
    rows = rows.withColumn("free", F.when(F.col("hat") < 1 - 1e-10, 1 - F.col("hat")))
    sse = float(rows.agg(F.sum(F.col("residual") * F.col("residual"))).first()[0] or 0.0)
    s2 = sse / (n - p) if n > p else float("nan")
    e, h, free = F.col("residual"), F.col("hat"), F.col("free")
    rows = rows.withColumn("cook", F.try_divide(e * e * h, F.lit(p * s2) * free * free))
    left_out = F.try_divide(F.lit(sse) - F.try_divide(e * e, free), F.lit(float(n - p - 1)))
    change = F.try_divide(x * e, free * F.sqrt(F.when(left_out > 0, left_out)))
    low, high = change * F.col("b_min"), change * F.col("b_max")
    return rows.withColumns({"dfbetas_max": F.greatest(low, high), "dfbetas_min": F.least(low, high)}).drop(
        "slope_fit", "leverage", "b_min", "b_max", "free")


def prune_influential(df: DataFrame, model: SlopeModel, cook: float = 4.0, dfbetas: float = 6.0,
                      two_sided: bool = False) -> DataFrame:
    """Keep rows with Cook's distance < cook*p/n and no DFBETAS above dfbetas/sqrt(n).

    The published rule looks at signed DFBETAS; ``two_sided`` also drops large negative ones.
    """
    fit = fit_ols(df, model)
    limit = dfbetas / np.sqrt(fit.n)
    keep = (F.col("cook") < cook * fit.rank / fit.n) & (F.col("dfbetas_max") <= limit)
    if two_sided:
        keep = keep & (F.col("dfbetas_min") >= -limit)
    return with_influence(df, fit).filter(keep).drop("residual", "hat", "cook", "dfbetas_max", "dfbetas_min")


def normal_equations(df: DataFrame, fit: OlsFit) -> DataFrame:
    """Relative residual of each normal equation, from the rows: all 0 up to rounding."""
    model = fit.model
    x = F.col(model.slope)
    rows = with_influence(df, fit)
    e = F.col("residual")
    parts = [F.struct(F.lit("all").alias("FACTOR"), F.lit("").alias("NIVEL")),
             *[F.struct(F.lit(f).alias("FACTOR"), F.col(f).cast("string").alias("NIVEL")) for f in model.factors]]
    long = rows.select(F.explode(F.array(*parts)).alias("t"), (x * e).alias("xe"),
                       (F.abs(x) * F.abs(F.col(model.response))).alias("scale"))
    return long.groupBy("t.FACTOR", "t.NIVEL").agg(
        F.try_divide(F.sum("xe"), F.sum("scale")).alias("RELATIVE"))
