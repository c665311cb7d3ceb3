"""Exact quantiles by several groupings at once, one way for groups of any size.

Equal values of the finest groups are counted before the shuffle, once for all groupings. The distinct ones are sorted by
(column, value) over slices whose number follows from how many there are. The rows of each group in each slice are counted,
which tells in which slice a group's quantile lies; only there, values are ranked. No group is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.functions.joins import null_safe_join
from rentlens.sources.store import stage

#: Distinct (finest group, value) pairs a slice holds, about: what one task sorts, whatever the size of the table.
SLICE = 500_000
LISTED, NAMED = -1, -2  #: metrics that stand for a row of a group, and for one with a value in the counted column


def lattice_quantiles(df: DataFrame, levels: dict[str, list[str]], cols: list[str], probs: list[float],
                      counted: str | None = None) -> DataFrame:
    """One row per level and group: LEVEL, the keys (null where a level leaves one out), N and ``<col>_q``.

    ``levels`` names the groupings. ``<col>_q`` is the array of the quantiles at ``probs`` (linear interpolation), N the number of
    rows (with a value in ``counted``, if given). Null and NaN values are missing; a group without values has a null in place of the
    array. Infinite values have their rank like any other, and a quantile between an infinite and a finite value is infinite. Null
    keys are a group. An empty table has no groups, at any level.
    """
    by = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    # own names for the keys, so that no column of the caller meets the working columns
    names = [f"_by{i}" for i in range(len(by))]
    group = ["LEVEL", *names]
    named = F.lit(True) if counted is None else F.col(counted).isNotNull()
    entry = [F.struct(F.lit(LISTED).alias("metric"), F.lit(0.0).alias("x")),
             F.struct(F.when(named, NAMED).alias("metric"), F.lit(0.0).alias("x")),
             *[F.struct(F.lit(i).alias("metric"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)]]
    long = df.select(*[F.col(g).alias(b) for g, b in zip(by, names)], F.explode(F.array(*entry)).alias("v"))
    long = long.select(*names, "v.metric", "v.x").filter("metric IS NOT NULL AND x IS NOT NULL AND NOT isnan(x)")
    values = stage(long.groupBy(*names, "metric", "x").agg(F.count(F.lit(1)).alias("c")), "values")
    placed = _sliced(values, ["metric", "x", *names])

    def expanded(rows: DataFrame) -> DataFrame:
        """Each row once per level, without the keys that the level leaves out."""
        made = F.array(*[F.struct(F.lit(level).alias("LEVEL"), *[
            (F.col(n) if g in keys else F.when(F.lit(False), F.col(n))).alias(n) for g, n in zip(by, names)])
            for level, keys in levels.items()])
        others = [c for c in rows.columns if c not in names]
        return rows.select(F.explode(made).alias("g"), *others).select("g.*", *others)

    inner = placed.groupBy(*names, "metric", "slice").agg(F.sum("c").alias("rows"))
    sizes = expanded(inner).groupBy(*group, "metric", "slice").agg(F.sum("rows").alias("rows"))
    over = Window.partitionBy(*group, "metric")  # as many rows as there are slices
    sizes = sizes.withColumns({
        "before": F.coalesce(F.sum("rows").over(over.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "n": F.sum("rows").over(over)})

    spots = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    ranks = [f(h) for h in spots for f in (F.floor, F.ceil)]
    hit = F.exists(F.array(*ranks), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("rows")))
    wanted = sizes.filter((F.col("metric") >= 0) & hit).drop("rows")
    near = null_safe_join(expanded(placed.filter(F.col("metric") >= 0)), wanted, [*group, "metric", "slice"])
    near = near.groupBy(*group, "metric", "slice", "before", "n", "x").agg(F.sum("c").alias("c"))
    inside = Window.partitionBy(*group, "metric", "slice").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("before") + F.col("upto")  # ranks from 0: [last - c, last)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= last - F.col("c")) & (rank < last), F.col("x")))

    found = near.withColumn("upto", F.sum("c").over(inside)).groupBy(*group, "metric").agg(
        F.max("n").alias("n"),
        *[at(f(h)).alias(f"{side}{i}") for i, h in enumerate(spots) for side, f in (("low", F.floor), ("high", F.ceil))])

    def quantile(i: int) -> Column:
        part = spots[i] - F.floor(spots[i])
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        return F.when((part == 0) | (low == high), low).otherwise(low * (1 - part) + high * part)

    q = F.array(*[quantile(i) for i in range(len(probs))])
    listed = sizes.filter(F.col("metric") < 0).select(*group, "metric", "rows", F.lit(None).cast("array<double>").alias("q"))
    rows = listed.unionByName(found.select(*group, "metric", F.lit(0).cast("long").alias("rows"), q.alias("q")))
    wide = rows.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(F.col("metric") == NAMED, F.col("rows"))), F.lit(0)).alias("_n"),
        *[F.max(F.when(F.col("metric") == i, F.col("q"))).alias(f"_q{i}") for i in range(len(cols))])
    return wide.select("LEVEL", *[F.col(b).alias(g) for g, b in zip(by, names)], F.col("_n").alias("N"),
                       *[F.col(f"_q{i}").alias(f"{c}_q") for i, c in enumerate(cols)])


def _sliced(values: DataFrame, order: list[str]) -> DataFrame:
    """``values`` (a stage table) with the number of its slice in the given order; what fits one slice needs no sort."""
    parts = -(-values.count() // SLICE)
    if parts <= 1:
        return values.withColumn("slice", F.lit(0))
    return stage(values.repartitionByRange(parts, *order).withColumn("slice", F.spark_partition_id()), "ordered")


def exact_quantiles(df: DataFrame, by: list[str], cols: list[str], probs: list[float]) -> DataFrame:
    """One row per group with ``<col>_q`` = array of the quantiles at ``probs``; see ``lattice_quantiles``."""
    return lattice_quantiles(df, {"": by}, cols, probs).select(*by, *[f"{c}_q" for c in cols])


def exact_medians(df: DataFrame, by: list[str], cols: dict[str, str]) -> DataFrame:
    """Medians of the columns in ``cols`` (column -> output name)."""
    q = exact_quantiles(df, by, list(cols), [0.5])
    return q.select(*by, *[F.col(f"{c}_q")[0].alias(name) for c, name in cols.items()])
