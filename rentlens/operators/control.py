"""Hotelling T2 control chart per pool, and the two-pass quality control.

A pass reads the listings twice: once for moments per (segment, sector), once to score rows. Pools and their
moments are merged on the sector table in between, so no listing is shuffled by pool.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions import special
from rentlens.operators.clean import SEGMENT, fill_group_mean
from rentlens.operators.pooling import pool_sectors
from rentlens.sources.store import stage

# workers need not have this package installed
cloudpickle.register_pickle_by_value(special)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEASURES = ["PRECIO", "VALOR_M2_INTEGRAL", "AREA_CONSTRUIDA"]
SINGULAR = float(np.finfo(float).eps)


def _pairs(cols: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def moments(df: DataFrame, by: list[str], cols: list[str] = MEASURES, weight: str | None = None) -> DataFrame:
    """Count, extremes, means, variances and covariances (n - 1) per group; no group is collected.

    A row counts as often as ``weight`` says, as if it were repeated.
    """
    if weight is not None:
        return _repeated_moments(df, by, cols, weight)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean{i}") for i, c in enumerate(cols)],
        *[F.min(c).alias(f"min{i}") for i, c in enumerate(cols)],
        *[F.max(c).alias(f"max{i}") for i, c in enumerate(cols)],
        *[F.var_samp(c).alias(f"var{i}") for i, c in enumerate(cols)],
        *[F.covar_samp(cols[i], cols[j]).alias(f"cov{i}{j}") for i, j in _pairs(cols)])


def _repeated_moments(df: DataFrame, by: list[str], cols: list[str], weight: str) -> DataFrame:
    """Moments of rows that each stand for ``weight`` equal ones.

    Rows of one weight, and with values in the same columns, have their moments first; their groups are put together in
    windows over the table of groups. A column takes part where it has values, a pair where both have.
    """
    k, pairs = range(len(cols)), _pairs(cols)
    holes = {f"hole{i}": F.col(c).isNull() for i, c in enumerate(cols)}
    parts = moments(df.withColumns(holes), [*by, weight, *holes], cols).withColumn("rows", F.col("n") * F.col(weight))
    over = Window.partitionBy(*by)

    def centre(i: int, has: Column) -> Column:
        return F.try_divide(F.sum(F.when(has, F.col("rows") * F.col(f"mean{i}"))).over(over),
                            F.sum(F.when(has, F.col("rows"))).over(over))

    def spread(inner: str, a: Column, b: Column, has: Column) -> Column:
        within = F.col(weight) * (F.col("n") - 1) * F.coalesce(F.col(inner), F.lit(0.0))
        return F.try_divide(F.sum(F.when(has, within + F.col("rows") * a * b)), F.sum(F.when(has, F.col("rows"))) - 1)

    one = [~F.col(f"hole{i}") for i in k]
    both = {(i, j): one[i] & one[j] for i, j in pairs}
    placed = parts.withColumns({**{f"at{i}": centre(i, one[i]) for i in k},
                                **{f"at{i}_{i}{j}": centre(i, both[i, j]) for i, j in pairs},
                                **{f"at{j}_{i}{j}": centre(j, both[i, j]) for i, j in pairs}})

    def gap(i: int, name: str) -> Column:
        return F.col(f"mean{i}") - F.col(name)

    return placed.groupBy(*by).agg(
        F.sum("rows").alias("n"),
        *[F.max(f"at{i}").alias(f"mean{i}") for i in k],
        *[F.min(f"min{i}").alias(f"min{i}") for i in k],
        *[F.max(f"max{i}").alias(f"max{i}") for i in k],
        *[spread(f"var{i}", gap(i, f"at{i}"), gap(i, f"at{i}"), one[i]).alias(f"var{i}") for i in k],
        *[spread(f"cov{i}{j}", gap(i, f"at{i}_{i}{j}"), gap(j, f"at{j}_{i}{j}"), both[i, j]).alias(f"cov{i}{j}")
          for i, j in pairs])


def constant_columns(df: DataFrame, by: list[str], cols: list[str] = MEASURES) -> DataFrame:
    """Whether each column holds one value in the group."""
    return df.groupBy(*by).agg(*[(F.min(c) == F.max(c)).alias(f"{c}_CONSTANT") for c in cols])


def merge_moments(parts: DataFrame, by: list[str], size: int = 3) -> DataFrame:
    """Moments of unions of groups from the moments of the groups."""
    k = range(size)
    pairs = [(i, j) for i in k for j in range(i + 1, size)]
    centres = parts.groupBy(*by).agg(
        F.sum("n").alias("total"),
        *[(F.sum(F.col("n") * F.col(f"mean{i}")) / F.sum("n")).alias(f"centre{i}") for i in k])
    joined = parts.join(centres, by)

    def spread(i: int, j: int) -> Column:
        inner = F.col(f"var{i}") if i == j else F.col(f"cov{i}{j}")
        gap = [F.col(f"mean{a}") - F.col(f"centre{a}") for a in (i, j)]
        within = (F.col("n") - 1) * F.coalesce(inner, F.lit(0.0))
        return F.try_divide(F.sum(within + F.col("n") * gap[0] * gap[1]), F.sum("n") - 1)

    return joined.groupBy(*by).agg(
        F.sum("n").alias("n"),
        *[F.first(f"centre{i}").alias(f"mean{i}") for i in k],
        *[F.min(f"min{i}").alias(f"min{i}") for i in k],
        *[F.max(f"max{i}").alias(f"max{i}") for i in k],
        *[spread(i, i).alias(f"var{i}") for i in k],
        *[spread(i, j).alias(f"cov{i}{j}") for i, j in pairs])


def _upper(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i, size)]


def _inverses(corr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of each correlation matrix, and which of them have none."""
    none = np.linalg.det(corr) == 0
    safe = np.where(none[:, None, None], np.eye(corr.shape[1]), corr)
    return np.linalg.inv(safe), none


def _solve(stats: pd.DataFrame, size: int, confidence: float, tol: float, scaled: bool) -> pd.DataFrame:
    """Columns in use, inverse correlation and limit for a batch of groups."""
    k = range(size)
    cov = np.zeros((len(stats), size, size))
    for i, j in _upper(size):
        cov[:, i, j] = cov[:, j, i] = stats[f"var{i}" if i == j else f"cov{i}{j}"].fillna(0.0)
    low, high = (np.stack([stats[f"{n}{i}"] for i in k], axis=1).astype(float) for n in ("min", "max"))
    variance = np.stack([cov[:, i, i] for i in k], axis=1)
    on = (low < high) & (variance > 0)
    sd = np.sqrt(np.where(variance > 0, variance, 1.0))
    corr = cov / (sd[:, :, None] * sd[:, None, :])
    unit = np.ones_like(sd) if scaled else sd

    for _ in k:
        # columns that are out are decoupled, which leaves the inverse of the others unchanged
        both = on[:, :, None] & on[:, None, :]
        used = np.where(both, corr, 0.0)
        used[:, range(size), range(size)] = 1.0
        inverse, none = _inverses(used)
        scale = unit[:, :, None] * unit[:, None, :]
        norm = np.abs(np.where(both, used * scale, 0.0)).sum(axis=1).max(axis=1)
        inverse_norm = np.abs(np.where(both, inverse / scale, 0.0)).sum(axis=1).max(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            rcond = np.where(none, 0.0, 1.0 / (norm * inverse_norm))
        bad = (on.sum(axis=1) > 1) & (rcond < tol) | none
        if not bad.any():
            break
        last = size - 1 - np.argmax(on[:, ::-1], axis=1)
        on[bad, last[bad]] = False

    m, p = stats["n"].to_numpy(dtype=float), on.sum(axis=1)
    # pools share few sizes: one quantile per distinct (m, p)
    known, place = np.unique(np.stack([m, p], axis=1), axis=0, return_inverse=True)
    mm, pp = known[:, 0], known[:, 1]
    q = special.beta_quantile(confidence, np.where(pp > 0, pp / 2, -1.0), (mm - pp - 1) / 2)
    ucl = ((mm - 1) ** 2 / mm * q)[place.ravel()]
    return pd.DataFrame({
        **{f"on{i}": on[:, i] for i in k},
        **{f"inv{i}{j}": inverse[:, i, j] for i, j in _upper(size)},
        "p": p.astype("int32"), "ucl": pd.Series(ucl).astype(object).where(~np.isnan(ucl), None)})


def chart_parameters(stats: DataFrame, size: int = 3, confidence: float = 0.9,
                     singular_tol: float = SINGULAR, scaled: bool = False) -> DataFrame:
    """Per group: which columns enter (on0..), the inverse correlation entries, p and the upper limit.

    Constant columns leave first. If the covariance of the rest is singular (reciprocal condition number in
    the 1-norm under ``singular_tol``), the longest leading prefix that is not singular stays. With ``scaled``
    the test looks at the correlation instead, which does not depend on units. The limit for individual
    observations is (m-1)^2/m times the Beta(p/2, (m-p-1)/2) quantile, and null where m <= p + 1.

    ``stats`` has one row per group, so the matrix work is one numpy batch per few thousand groups.
    """
    new = [*[T.StructField(f"on{i}", T.BooleanType()) for i in range(size)],
           *[T.StructField(f"inv{i}{j}", T.DoubleType()) for i, j in _upper(size)],
           T.StructField("p", T.IntegerType()), T.StructField("ucl", T.DoubleType())]
    def batches(frames):
        for frame in frames:
            if len(frame):
                found = _solve(frame, size, confidence, singular_tol, scaled)
                yield pd.concat([frame.reset_index(drop=True), found], axis=1)

    return stats.mapInPandas(batches, T.StructType([*stats.schema.fields, *new]))


def t2_expression(cols: list[str]) -> Column:
    """T2 of a row from the parameters of its group."""
    k = range(len(cols))
    z = [F.when(F.col(f"on{i}"), F.try_divide(F.col(c) - F.col(f"mean{i}"), F.sqrt(F.col(f"var{i}"))))
         .otherwise(F.lit(0.0)) for i, c in enumerate(cols)]
    total = sum((z[i] * z[i] * F.col(f"inv{i}{i}") for i in k), F.lit(0.0))
    total = total + sum((2 * z[i] * z[j] * F.col(f"inv{i}{j}") for i in k for j in range(i + 1, len(cols))),
                        F.lit(0.0))
    return F.when(F.col("p") > 0, total)


def _parameter_columns(size: int) -> list[str]:
    k = range(size)
    return [*[f"{name}{i}" for name in ("mean", "var", "on") for i in k],
            *[f"inv{i}{j}" for i in k for j in range(i, size)], "n", "p", "ucl"]


def _scored(df: DataFrame, parameters: DataFrame, on: list[str], cols: list[str]) -> DataFrame:
    names = _parameter_columns(len(cols))
    # a left join keeps rows whose segment is unknown; they have no limit and stay
    scored = df.join(parameters, on, "left").withColumn("t2", t2_expression(cols))
    scored = scored.withColumnsRenamed({"n": "pool_n", "p": "pool_p"})
    scored = scored.withColumn("is_outlier", F.coalesce(F.col("t2") > F.col("ucl"), F.lit(False)))
    return scored.drop(*[c for c in names if c not in ("n", "p", "ucl")])


def t2_chart(df: DataFrame, by: list[str], cols: list[str] = MEASURES, confidence: float = 0.9,
             singular_tol: float = SINGULAR, scaled: bool = False) -> DataFrame:
    """Rows with their T2, the group's limit, and whether they lie beyond it. Groups without a limit keep all."""
    stats = moments(df, by, cols)
    parameters = chart_parameters(stats, len(cols), confidence, singular_tol, scaled)
    small = stage(parameters.select(*by, *_parameter_columns(len(cols))), "chart-limits")
    return _scored(df, small, by, cols)


def control_pass(df: DataFrame, cutoff: int = 10, confidence: float = 0.9, cols: list[str] = MEASURES,
                 singular_tol: float = SINGULAR, scaled: bool = False, weight: str | None = None) -> DataFrame:
    """Pool small sectors and score every row: adds CODIGO_BARRIO_NEW, t2, ucl and is_outlier.

    ``weight`` names the number of equal rows that a row stands for.
    """
    size = len(cols)
    sectors = stage(moments(df, [*SEGMENT, "CODIGO_BARRIO"], cols, weight), "sector-moments")
    counts = sectors.select(*SEGMENT, F.col("CODIGO_BARRIO").alias("code"), "n")
    pools = pool_sectors(counts, SEGMENT, cutoff).select(
        *SEGMENT, F.col("code").alias("CODIGO_BARRIO"), F.col("pool").alias("CODIGO_BARRIO_NEW"))
    pooled = merge_moments(sectors.join(pools, [*SEGMENT, "CODIGO_BARRIO"]), [*SEGMENT, "CODIGO_BARRIO_NEW"], size)
    limits = chart_parameters(pooled, size, confidence, singular_tol, scaled)
    lookup = stage(pools.join(limits, [*SEGMENT, "CODIGO_BARRIO_NEW"])
                   .select(*SEGMENT, "CODIGO_BARRIO", "CODIGO_BARRIO_NEW", *_parameter_columns(size)),
                   "sector-limits")
    return _scored(df, lookup, [*SEGMENT, "CODIGO_BARRIO"], cols).withColumn(
        "CODIGO_BARRIO_NEW", F.coalesce("CODIGO_BARRIO_NEW", "CODIGO_BARRIO"))


def quality_control(df: DataFrame, passes: int = 2, cutoff: int = 10, confidence: float = 0.9,
                    cols: list[str] = MEASURES, singular_tol: float = SINGULAR, scaled: bool = False,
                    save: Callable[[DataFrame, str], DataFrame] | None = None, weight: str | None = None) -> DataFrame:
    """Rows that stay inside the limits in every pass; pools are rebuilt from the survivors each time.

    ``df`` is read several times and should be a stored table. A pass stores its limits, not its rows: these are ``df``
    scored again, with the columns that the reader asks for. ``save`` stores the rows after each pass but the last.
    ``weight`` names the number of equal rows that a row stands for.
    """
    kept = df
    if "AREA_CONSTRUIDA" in cols and not df.filter(F.col("AREA_CONSTRUIDA").isNull()).isEmpty():
        kept = stage(fill_group_mean(kept, ["AREA_CONSTRUIDA"], SEGMENT, weight), "qc-input")
    for k in range(1, passes + 1):
        scored = control_pass(kept.drop("CODIGO_BARRIO_NEW"), cutoff, confidence, cols, singular_tol, scaled, weight)
        kept = scored.filter(~F.col("is_outlier")).drop("t2", "ucl", "is_outlier", "pool_n", "pool_p")
        if k < passes and save is not None:
            kept = save(kept, f"qc-pass-{k}")
    return kept


def chart_points(chart: DataFrame, by: list[str], order_by: list[str]) -> DataFrame:
    """Control-chart data: position in the group, T2, limit and ``in``/``out``."""
    return numbered(chart, by, order_by, "label").withColumn(
        "out", F.when(F.col("is_outlier"), "out").otherwise("in"))


def numbered(df: DataFrame, by: list[str], order_by: list[str], name: str) -> DataFrame:
    """Row number within the group, without giving any group to one task.

    Rows are range-sorted over all partitions, ties split by a hash of the row, and stored with their place.
    The number is the place in the partition plus the group's rows in earlier partitions.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism,
                int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [*by, *order_by, F.xxhash64(*df.columns)]
    placed = stage(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                   .withColumn("place", F.monotonically_increasing_id()), "ordered")
    # the id holds the partition in its upper bits and the place within it in the lower 33
    placed = placed.withColumns({"slice": F.shiftright("place", 33),
                                 "place": F.col("place").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy(*by, "slice").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    before = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first") + 1
    shifts = stage(sizes.select(*by, "slice", shift.alias("shift")), "offsets")
    return (placed.join(shifts, [*by, "slice"]).withColumn(name, F.col("place") + F.col("shift"))
            .drop("slice", "place", "shift"))
