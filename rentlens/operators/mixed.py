"""Linear mixed model: varying slopes as fixed effects, one random slope per sector, REML or ML.

With theta = var(random slope)/var(error), c = theta/(1 + theta s) and per sector s = sum(rent^2),
u = X'rent, w = rent'sale, the profile likelihood needs X'X - sum(c u u'), X'y - sum(c w u) and
y'y - sum(c w^2). One aggregate over the sector table yields these for many values of theta at once; only
matrices of coefficient size reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.functions.special import chi2_tail
from rentlens.operators.design import SlopeModel, coefficient_table, cross_products, independent_columns
from rentlens.sources.store import stage

COARSE = np.concatenate([[0.0], 10.0 ** np.linspace(-6, 6, 25)])
LAST = 1e60  # where the search for the variance ratio gives up, with an error
STEP = 1e-9  # the search ends with a step of the logarithm of the ratio below this


@dataclass(frozen=True)
class MixedFit:
    model: SlopeModel
    group: str
    method: str
    beta: np.ndarray
    theta: float
    sigma2: float
    loglik: float
    n: int
    p: int
    coefs: DataFrame
    ranef: DataFrame

    @property
    def random_variance(self) -> float:
        return self.theta * self.sigma2


def sector_terms(df: DataFrame, model: SlopeModel, group: str) -> DataFrame:
    """Per sector: s and the array of (term, u); the response is the last term. At most p + 1 entries each."""
    x, y = F.col(model.slope), F.col(model.response)
    cells = model.rows(df).groupBy(group, *model.factors).agg(
        F.sum(x * x).alias("xx"), F.sum(x * y).alias("xy"))
    where = {t: i for i, t in enumerate(model.terms)}
    parts = [F.struct(F.lit(0).alias("term"), F.col("xx").alias("u"))]
    for f in model.factors:
        index = F.lit(None).cast("int")
        entries = [v for pair in ((F.lit(v), F.lit(where[f, v])) for v in model.levels[f][1:]) for v in pair]
        if entries:
            index = F.create_map(*entries)[F.col(f)]
        parts.append(F.struct(index.alias("term"), F.col("xx").alias("u")))
    parts.append(F.struct(F.lit(len(where)).alias("term"), F.col("xy").alias("u")))
    long = (cells.select(group, F.explode(F.array(*parts)).alias("t")).select(group, "t.term", "t.u")
            .filter(F.col("term").isNotNull()).groupBy(group, "term").agg(F.sum("u").alias("u")))
    return long.groupBy(group).agg(
        F.max(F.when(F.col("term") == 0, F.col("u"))).alias("s"),
        F.sort_array(F.collect_list(F.struct("term", "u"))).alias("terms"))


def term_pairs(sectors: DataFrame) -> DataFrame:
    """(i, j, s, uu) for the pairs of terms of each sector, response included: what every evaluation adds up."""
    left = sectors.select("s", "terms", F.explode("terms").alias("a"))
    return (left.select("s", "a", F.explode("terms").alias("b")).filter(F.col("a.term") <= F.col("b.term"))
            .select(F.col("a.term").alias("i"), F.col("b.term").alias("j"), "s", (F.col("a.u") * F.col("b.u")).alias("uu")))


def shrunk_sums(pairs: DataFrame, thetas: list[float], size: int, orders: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """At [k, d]: the d-th derivatives at the k-th theta of sum(c u u'), a matrix, and of sum(log(1 + theta s)), a number,
    over the sectors. One job, whose result is as large as the matrices."""
    s = F.col("s")
    columns = []
    for k, t in enumerate(thetas):
        base = 1 + F.lit(float(t)) * s
        weights = [F.lit(float(t)) / base, 1 / (base * base), -2 * s / (base * base * base)]
        logs = [F.log1p(F.lit(float(t)) * s), s / base, -s * s / (base * base)]
        for d in range(orders):
            columns += [F.sum(F.col("uu") * weights[d]).alias(f"g{k}_{d}"), F.sum(logs[d]).alias(f"l{k}_{d}")]
    out, logs = np.zeros((len(thetas), orders, size, size)), np.zeros((len(thetas), orders))
    for r in pairs.groupBy("i", "j").agg(*columns).collect():
        for k in range(len(thetas)):
            for d in range(orders):
                out[k, d, r["i"], r["j"]] = out[k, d, r["j"], r["i"]] = r[f"g{k}_{d}"]
                if r["i"] == r["j"] == 0:  # every sector has the common slope's term, once
                    logs[k, d] = r[f"l{k}_{d}"]
    return out, logs


def shrunk_products(sectors: DataFrame, thetas: list[float], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each theta, sum(c u u') over sectors (response included) and sum(log(1 + theta s))."""
    found, logs = shrunk_sums(term_pairs(sectors), thetas, size)
    return list(found[:, 0]), logs[:, 0]


def profile(gram: np.ndarray, shrunk: np.ndarray, logs: float, n: int, kept: list[int],
            method: str) -> tuple[float, float, np.ndarray]:
    """Log-likelihood, error variance and coefficients at one theta, over the kept columns."""
    m = gram - shrunk
    a, b = m[np.ix_(kept, kept)], m[kept, -1]
    beta = np.linalg.solve(a, b)
    q = m[-1, -1] - b @ beta
    free = n - len(kept) if method == "REML" else n
    sigma2 = q / free
    if not sigma2 > 0:
        return -np.inf, np.nan, beta
    value = free * (np.log(2 * np.pi * sigma2) + 1) + logs
    if method == "REML":
        value += np.linalg.slogdet(a)[1]
    return -0.5 * value, sigma2, beta


def profile_table(df: DataFrame, model: SlopeModel, group: str, thetas: list[float],
                  method: str = "REML") -> DataFrame:
    """The profile likelihood on a list of theta values."""
    gram, n = cross_products(df, model)
    kept = independent_columns(gram[:-1, :-1])
    sectors = stage(sector_terms(df, model, group), "sector-terms")
    shrunk, logs = shrunk_products(sectors, thetas, len(gram))
    rows = []
    for t, s, v in zip(thetas, shrunk, logs):
        value, sigma2, _ = profile(gram, s, v, n, kept, method)
        rows.append((float(t), float(value), float(sigma2)))
    return df.sparkSession.createDataFrame(rows, "THETA double, LOGLIK double, SIGMA2 double")


def profile_slope(gram: np.ndarray, shrunk: np.ndarray, logs: np.ndarray, n: int, kept: list[int],
                  method: str) -> tuple[float, float]:
    """First and second derivative by theta of the profile likelihood at one theta.

    With m the shrunk products and v = (-beta, 1), q = v'mv is the least residual sum; its derivatives follow from those of m
    alone, as q is stationary in beta. For REML, log|A| adds tr(A^-1 A') and its derivative.
    """
    m = [gram - shrunk[0], -shrunk[1], -shrunk[2]]
    a, first, second = (x[np.ix_(kept, kept)] for x in m)
    beta = np.linalg.solve(a, m[0][kept, -1])
    v = np.append(-beta, 1.0)
    whole = [*kept, len(gram) - 1]
    q, q1, q2 = (v @ x[np.ix_(whole, whole)] @ v for x in m)
    rest = m[1][kept, -1] - first @ beta
    q2 -= 2 * rest @ np.linalg.solve(a, rest)
    free = n - len(kept) if method == "REML" else n
    slope, curve = free * q1 / q + logs[1], free * (q2 / q - (q1 / q) ** 2) + logs[2]
    if method == "REML":
        inner = np.linalg.solve(a, first)
        slope += np.trace(inner)
        curve += np.trace(np.linalg.solve(a, second)) - np.trace(inner @ inner)
    return -0.5 * slope, -0.5 * curve


@dataclass
class _Search:
    """The search for one model: a bracket of log(theta) in which the score changes its sign, and the best point yet."""

    low: float
    high: float
    at: float
    best: tuple[float, float, float, np.ndarray]  # theta, log-likelihood, error variance, coefficients
    done: bool = False

    def move(self, slope: float, curve: float) -> None:
        """A Newton step in log(theta); the middle of the bracket where that leaves it or the likelihood is not concave."""
        theta = np.exp(self.at)
        score, information = theta * slope, -(theta * slope + theta * theta * curve)
        if score > 0:
            self.low = self.at
        else:
            self.high = self.at
        new = self.at + score / information if information > 0 else np.inf
        if not self.low < new < self.high:
            new = 0.5 * (self.low + self.high)
        self.done = abs(new - self.at) < STEP
        self.at = new


def _maximise(sectors: DataFrame, gram: np.ndarray, n: int, columns: list[list[int]], method: str):
    """Best (theta, loglik, sigma2, beta) for each nested column list.

    A coarse grid finds where the likelihood of each model is greatest, then all models take safeguarded Newton steps together:
    likelihood, score and information of every model come from one aggregate over the sectors. The boundary, no variation
    between sectors, is taken where the likelihood falls from there.
    """
    scale = float(sectors.agg(F.avg("s")).first()[0])
    pairs = stage(term_pairs(sectors), "term-pairs")
    grid = [float(v) for v in COARSE / scale]

    def evaluate(thetas: list[float], orders: int = 1):
        shrunk, logs = shrunk_sums(pairs, thetas, len(gram), orders)
        return shrunk, logs, [[profile(gram, s[0], v[0], n, c, method) for s, v in zip(shrunk, logs)] for c in columns]

    shrunk, logs, coarse = evaluate(grid, 3)
    at_zero = [profile_slope(gram, shrunk[0], logs[0], n, c, method)[0] for c in columns]
    while True:
        best = [int(np.argmax([v[0] for v in values])) for values in coarse]
        if max(best) < len(grid) - 1:
            break
        # still rising at the end: go on, by as many decades as the grid has
        if grid[-1] * scale > LAST:
            raise ArithmeticError("the likelihood still rises at the end of the search: the errors have no variance")
        more = [grid[-1] * float(v) for v in 10.0 ** np.linspace(0.5, 12, 24)]
        grid += more
        coarse = [a + b for a, b in zip(coarse, evaluate(more)[2])]
    searches = []
    for k, i in enumerate(best):
        first = np.log(grid[1]) - 12 * np.log(10)  # below it a ratio cannot be told from the boundary
        low, high = np.log(grid[i - 1]) if i > 1 else first, np.log(grid[i + 1])
        search = _Search(low, high, np.log(grid[max(i, 1)]), (grid[i], *coarse[k][i]))
        search.done = i == 0 and at_zero[k] <= 0
        searches.append(search)
    for _ in range(200):
        open_ones = [k for k, s in enumerate(searches) if not s.done]
        if not open_ones:
            break
        shrunk, logs, values = evaluate([float(np.exp(searches[k].at)) for k in open_ones], 3)
        for place, k in enumerate(open_ones):
            search, value = searches[k], values[k][place]
            if value[0] >= search.best[1]:
                search.best = (float(np.exp(search.at)), *value)
            search.move(*profile_slope(gram, shrunk[place], logs[place], n, columns[k], method))
    return [s.best for s in searches]


def fit_nested(df: DataFrame, model: SlopeModel, group: str = "CODIGO_BARRIO",
               method: str = "REML") -> list[MixedFit]:
    """The models that add one factor at a time, from the common slope to all of ``model``."""
    gram, n = cross_products(df, model)
    kept = independent_columns(gram[:-1, :-1])
    sectors = stage(sector_terms(df, model, group), "sector-terms")
    steps = [[c for c in kept if model.terms[c][0] in ("all", *model.factors[:k])]
             for k in range(len(model.factors) + 1)]
    return [_fitted(sectors, model, group, method, n, columns, *best)
            for columns, best in zip(steps, _maximise(sectors, gram, n, steps, method))]


def fit_mixed(df: DataFrame, model: SlopeModel, group: str = "CODIGO_BARRIO", method: str = "REML") -> MixedFit:
    gram, n = cross_products(df, model)
    kept = independent_columns(gram[:-1, :-1])
    sectors = stage(sector_terms(df, model, group), "sector-terms")
    return _fitted(sectors, model, group, method, n, kept, *_maximise(sectors, gram, n, [kept], method)[0])


def fit_at(df: DataFrame, model: SlopeModel, theta: float, group: str = "CODIGO_BARRIO",
           method: str = "REML") -> MixedFit:
    """The model at a given variance ratio."""
    gram, n = cross_products(df, model)
    kept = independent_columns(gram[:-1, :-1])
    sectors = stage(sector_terms(df, model, group), "sector-terms")
    shrunk, logs = shrunk_products(sectors, [theta], len(gram))
    return _fitted(sectors, model, group, method, n, kept, theta,
                   *profile(gram, shrunk[0], logs[0], n, kept, method))


def _fitted(sectors: DataFrame, model: SlopeModel, group: str, method: str, n: int, columns: list[int],
            theta: float, loglik: float, sigma2: float, short: np.ndarray) -> MixedFit:
    beta = np.full(len(model.terms), np.nan)
    beta[columns] = short
    coefs = coefficient_table(sectors.sparkSession, model, beta)
    return MixedFit(model, group, method, beta, theta, sigma2, loglik, n, len(columns), coefs,
                    random_effects(sectors, group, beta, theta))


def random_effects(sectors: DataFrame, group: str, beta: np.ndarray, theta: float) -> DataFrame:
    """Predicted random slope of each sector: c (w - u'beta)."""
    signed = F.array(*[F.lit(-float(b)) for b in np.nan_to_num(beta)], F.lit(1.0))
    rest = F.aggregate("terms", F.lit(0.0), lambda total, t: total + t["u"] * signed[t["term"]])
    c = F.lit(float(theta)) / (1 + F.lit(float(theta)) * F.col("s"))
    return sectors.select(group, (c * rest).alias("RAN_EFFECT"))


def anova(spark: SparkSession, fits: list[MixedFit]) -> DataFrame:
    """Likelihood-ratio table of nested models.

    REML likelihoods of models with different fixed effects are not comparable; ``method="ML"`` fits give the
    valid test, REML fits the published table.
    """
    rows, before = [], None
    for k, fit in enumerate(fits, start=1):
        size = fit.p + 2
        nobs = fit.n - fit.p if fit.method == "REML" else fit.n
        ratio = prob = None
        if before is not None:
            ratio = float(2 * abs(fit.loglik - before.loglik))
            more = abs(fit.p - before.p)
            prob = float(chi2_tail(ratio, more)) if more else None
        rows.append((k, size, float(2 * size - 2 * fit.loglik), float(size * np.log(nobs) - 2 * fit.loglik),
                     float(fit.loglik), ratio, prob))
        before = fit
    return spark.createDataFrame(
        rows, "Model int, df int, AIC double, BIC double, logLik double, L_Ratio double, p_value double")


def nested_anova(df: DataFrame, model: SlopeModel, group: str = "CODIGO_BARRIO",
                 method: str = "REML") -> DataFrame:
    return anova(df.sparkSession, fit_nested(df, model, group, method))


def with_fitted(df: DataFrame, fit: MixedFit) -> DataFrame:
    """Fitted values (random effect included) and residuals."""
    model = fit.model
    known = {t: float(b) for t, b in zip(model.terms, np.nan_to_num(fit.beta))}
    slope = F.lit(known["all", None])
    for f in model.factors:
        entries = [v for level in model.levels[f] for v in (F.lit(level), F.lit(known.get((f, level), 0.0)))]
        slope = slope + F.create_map(*entries)[F.col(f)]
    rows = model.rows(df).join(fit.ranef, fit.group, "left")
    rows = rows.withColumn("Fitted", F.col(model.slope) * (slope + F.coalesce("RAN_EFFECT", F.lit(0.0))))
    return rows.withColumn("Residuals", F.col(model.response) - F.col("Fitted"))
