import numpy as np
import pytest

from rentlens.operators import design, mixed, ols

FACTORS = ("ESTRATO", "CODIGO_LOCALIDAD", "ANO")


def cohorts(seed=1, n=250, sectors=30, theta=2e-3, noise=20.0, drop=None):
    rng = np.random.default_rng(seed)
    rows = []
    effect = rng.normal(size=sectors) * noise * np.sqrt(theta)
    for _ in range(n):
        s = int(rng.integers(sectors))
        e, loc, year = int(rng.integers(1, 5)), str(1 + s % 4), int(rng.integers(2017, 2020))
        x = float(rng.uniform(20, 60))
        slope = 200 + 5 * (e - 1) - 3 * (int(loc) - 1) + 2 * (year - 2017) + effect[s]
        rows.append((f"{s:06d}", e, loc, year, x, float(slope * x + rng.normal() * noise)))
    return [r for r in rows if drop is None or not drop(r)]


def table(spark, rows):
    return spark.createDataFrame(rows, "CODIGO_BARRIO string, ESTRATO int, CODIGO_LOCALIDAD string, ANO int, "
                                       "PRECIO_MEAN_ARRIENDO double, PRECIO_MEAN_VENTA double")


def dense(rows, model):
    x = np.array([r[4] for r in rows])
    at = {"ESTRATO": 1, "CODIGO_LOCALIDAD": 2, "ANO": 3}
    columns = [x] + [x * np.array([r[at[f]] == v for r in rows]) for f, v in model.terms[1:]]
    return np.stack(columns, 1), np.array([r[5] for r in rows])


@pytest.fixture(scope="module")
def fitted(spark):
    rows = cohorts()
    df = table(spark, rows)
    return rows, df, design.slope_model(df)


def test_levels(spark, fitted):
    _, _, model = fitted
    assert model.levels == {"ESTRATO": [1, 2, 3, 4], "CODIGO_LOCALIDAD": ["1", "2", "3", "4"],
                            "ANO": [2017, 2018, 2019]}
    assert len(model.terms) == 9


def test_localities_sort_as_text(spark):
    df = table(spark, [("a", 1, loc, 2017, 1.0, 1.0) for loc in ("1", "10", "2", "19")])
    assert design.slope_model(df).levels["CODIGO_LOCALIDAD"] == ["1", "10", "19", "2"]


def test_cross_products(fitted):
    rows, df, model = fitted
    x, y = dense(rows, model)
    z = np.column_stack([x, y])
    gram, n = design.cross_products(df, model)
    assert n == len(rows)
    np.testing.assert_allclose(gram, z.T @ z, rtol=1e-12)


def test_ols(spark, fitted):
    rows, df, model = fitted
    x, y = dense(rows, model)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    fit = ols.fit_ols(df, model)
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-8)
    worst = max(abs(r["RELATIVE"]) for r in ols.normal_equations(df, fit).collect())
    assert worst < 1e-10


def _leave_one_out(rows, model):
    x, y = dense(rows, model)
    n, p = x.shape
    inverse = np.linalg.inv(x.T @ x)
    beta = inverse @ x.T @ y
    s2 = ((y - x @ beta) ** 2).sum() / (n - p)
    cook, dfb = [], []
    for i in range(n):
        keep = np.arange(n) != i
        b = np.linalg.lstsq(x[keep], y[keep], rcond=None)[0]
        s_i = np.sqrt(((y[keep] - x[keep] @ b) ** 2).sum() / (n - 1 - p))
        d = beta - b
        cook.append(d @ (x.T @ x) @ d / (p * s2))
        dfb.append(d / (s_i * np.sqrt(np.diag(inverse))))
    return np.array(cook), np.array(dfb)


def _by_row(found):
    return {(r["CODIGO_BARRIO"], r["PRECIO_MEAN_ARRIENDO"]): r for r in found}


def test_influence_is_leave_one_out(spark):
    rows = cohorts(seed=2, n=120)
    df = table(spark, rows)
    model = design.slope_model(df)
    cook, dfb = _leave_one_out(rows, model)
    found = _by_row(ols.with_influence(df, ols.fit_ols(df, model)).collect())
    assert len(found) == len(rows)
    for i, r in enumerate(rows):
        got = found[r[0], r[4]]
        assert got["cook"] == pytest.approx(cook[i], rel=1e-6)
        assert got["dfbetas_max"] == pytest.approx(dfb[i].max(), rel=1e-6)
        assert got["dfbetas_min"] == pytest.approx(dfb[i].min(), rel=1e-6)


@pytest.mark.parametrize("two_sided", [False, True])
def test_prune(spark, two_sided):
    rows = cohorts(seed=3, n=150)
    rows[5] = (*rows[5][:5], rows[5][5] * 3)
    rows[9] = (*rows[9][:5], rows[9][5] * 0.1)
    df = table(spark, rows)
    model = design.slope_model(df)
    cook, dfb = _leave_one_out(rows, model)
    n, p = len(rows), dfb.shape[1]
    keep = (cook < 4 * p / n) & (dfb <= 6 / np.sqrt(n)).all(axis=1)
    if two_sided:
        keep &= (dfb >= -6 / np.sqrt(n)).all(axis=1)
    found = _by_row(ols.prune_influential(df, model, two_sided=two_sided).collect())
    assert set(found) == {(r[0], r[4]) for i, r in enumerate(rows) if keep[i]}
    assert len(found) < n


def test_row_that_fixes_its_own_level_has_no_influence(spark):
    rows = cohorts(seed=4, n=80) + [("000099", 9, "1", 2017, 30.0, 6500.0)]
    df = table(spark, rows)
    found = ols.with_influence(df, ols.fit_ols(df, design.slope_model(df))).filter("ESTRATO = 9").first()
    assert found["cook"] is None


def test_dependent_columns_are_null(spark):
    # locality 4 occurs in year 2019 only, and 2019 in locality 4 only
    rows = cohorts(seed=5, drop=lambda r: (r[2] == "4") != (r[3] == 2019))
    df = table(spark, rows)
    model = design.slope_model(df)
    fit = ols.fit_ols(df, model)
    coefs = {(r["FACTOR"], r["NIVEL"]): r["COEF"] for r in ols.ols_coefficients(df, fit).collect()}
    assert coefs["year", "2019"] is None and coefs["loc", "4"] is not None
    x, y = dense(rows, model)
    residual = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    found = [r["residual"] for r in ols.with_influence(df, fit).collect()]
    assert sorted(found) == pytest.approx(sorted(residual), abs=1e-6)


def _dense_loglik(rows, model, theta, method):
    x, y = dense(rows, model)
    n, p = x.shape
    r = np.array([row[4] for row in rows])
    sector = np.array([row[0] for row in rows])
    v = np.eye(n) + theta * np.outer(r, r) * (sector[:, None] == sector[None, :])
    vi = np.linalg.inv(v)
    a = x.T @ vi @ x
    beta = np.linalg.solve(a, x.T @ vi @ y)
    e = y - x @ beta
    free = n - p if method == "REML" else n
    s2 = e @ vi @ e / free
    value = free * (np.log(2 * np.pi * s2) + 1) + np.linalg.slogdet(v)[1]
    if method == "REML":
        value += np.linalg.slogdet(a)[1]
    effects = {c: theta * (r * (sector == c)) @ vi @ e for c in set(sector)}
    return -0.5 * value, s2, beta, effects


@pytest.mark.parametrize("method", ["REML", "ML"])
def test_profile_is_the_dense_likelihood(spark, fitted, method):
    rows, df, model = fitted
    thetas = [0.0, 1e-4, 2e-3, 1e-1]
    for r in mixed.profile_table(df, model, "CODIGO_BARRIO", thetas, method).collect():
        loglik, s2, _, _ = _dense_loglik(rows, model, r["THETA"], method)
        assert r["LOGLIK"] == pytest.approx(loglik, rel=1e-9)
        assert r["SIGMA2"] == pytest.approx(s2, rel=1e-8)


@pytest.mark.parametrize("method", ["REML", "ML"])
def test_fit_is_the_maximum(spark, fitted, method):
    rows, df, model = fitted
    fit = mixed.fit_mixed(df, model, method=method)
    grid = fit.theta * np.exp(np.linspace(-1, 1, 41))
    best = max(_dense_loglik(rows, model, t, method)[0] for t in grid)
    assert fit.loglik >= best - 1e-6
    for step in (0.98, 1.02):
        assert fit.loglik >= _dense_loglik(rows, model, fit.theta * step, method)[0]
    loglik, s2, beta, effects = _dense_loglik(rows, model, fit.theta, method)
    np.testing.assert_allclose(fit.beta, beta, rtol=1e-8)
    found = {r["CODIGO_BARRIO"]: r["RAN_EFFECT"] for r in fit.ranef.collect()}
    assert found.keys() == effects.keys()
    for c, b in effects.items():
        assert found[c] == pytest.approx(b, rel=1e-6, abs=1e-8)


@pytest.mark.parametrize("method", ["REML", "ML"])
def test_score_and_information_are_the_derivatives(spark, method):
    df = table(spark, cohorts())
    model = design.slope_model(df)
    gram, n = design.cross_products(df, model)
    kept = design.independent_columns(gram[:-1, :-1])
    pairs = mixed.term_pairs(mixed.sector_terms(df, model, "CODIGO_BARRIO"))
    theta, h = 8e-4, 2e-6  # away from the maximum, where the score is nearly zero
    shrunk, logs = mixed.shrunk_sums(pairs, [theta - h, theta, theta + h], len(gram), 3)
    low, mid, high = (mixed.profile(gram, s[0], v[0], n, kept, method)[0] for s, v in zip(shrunk, logs))
    slopes = [mixed.profile_slope(gram, s, v, n, kept, method) for s, v in zip(shrunk, logs)]
    assert slopes[1][0] == pytest.approx((high - low) / (2 * h), rel=2e-3)
    assert slopes[1][1] == pytest.approx((slopes[2][0] - slopes[0][0]) / (2 * h), rel=2e-3)


@pytest.mark.parametrize("method", ["REML", "ML"])
def test_search_ends_where_the_score_is_zero(spark, method):
    df = table(spark, cohorts())
    model = design.slope_model(df)
    gram, n = design.cross_products(df, model)
    kept = design.independent_columns(gram[:-1, :-1])
    fits = mixed.fit_nested(df, model, method=method)
    pairs = mixed.term_pairs(mixed.sector_terms(df, model, "CODIGO_BARRIO"))
    for k, fit in enumerate(fits):
        columns = [c for c in kept if model.terms[c][0] in ("all", *model.factors[:k])]
        shrunk, logs = mixed.shrunk_sums(pairs, [fit.theta, fit.theta * 1.01], len(gram), 3)
        slope, curve = mixed.profile_slope(gram, shrunk[0], logs[0], n, columns, method)
        assert abs(fit.theta * slope) < 1e-3  # the score in log(theta), where the likelihood no longer tells points apart
        assert mixed.profile(gram, shrunk[1][0], logs[1][0], n, columns, method)[0] < fit.loglik


def test_planted_values_are_recovered(spark):
    rows = cohorts(seed=6, n=6000, sectors=200, theta=4e-3, noise=20.0)
    df = table(spark, rows)
    fit = mixed.fit_mixed(df, design.slope_model(df))
    assert fit.theta == pytest.approx(4e-3, rel=0.4)
    assert np.sqrt(fit.sigma2) == pytest.approx(20.0, rel=0.05)
    coefs = {(r["FACTOR"], r["NIVEL"]): r["COEF"] for r in fit.coefs.collect()}
    assert coefs["all", ""] == pytest.approx(200, abs=1.0)
    assert coefs["est", "3"] == pytest.approx(10, abs=0.5)
    assert coefs["year", "2019"] == pytest.approx(4, abs=0.5)


def test_maximum_far_beyond_the_first_grid(spark):
    rows = cohorts(seed=8, n=240, sectors=40, theta=1e8, noise=0.01)
    df = table(spark, rows)
    model = design.slope_model(df)
    fit = mixed.fit_mixed(df, model)
    around = mixed.profile_table(df, model, "CODIGO_BARRIO", [fit.theta * f for f in (0.5, 0.9, 1.0, 1.1, 2.0)]).collect()
    best = max(around, key=lambda r: r["LOGLIK"])
    assert best["THETA"] == pytest.approx(fit.theta) and fit.theta > 1e7
    assert fit.loglik == pytest.approx(best["LOGLIK"])


def test_no_variation_between_sectors(spark):
    rng = np.random.default_rng(7)
    rows = []
    for s in range(40):
        noise = rng.normal(size=10)
        x = rng.uniform(20, 60, size=10)
        noise -= x * (x @ noise) / (x @ x)  # no sector has a slope of its own
        rows += [(f"{s:06d}", 1, "1", 2017, float(a), float(200 * a + b)) for a, b in zip(x, noise)]
    fit = mixed.fit_mixed(table(spark, rows), design.SlopeModel({}))
    assert fit.theta == 0.0
    assert all(r["RAN_EFFECT"] == 0.0 for r in fit.ranef.collect())


@pytest.mark.parametrize("method", ["REML", "ML"])
def test_anova(spark, fitted, method):
    rows, df, model = fitted
    found = mixed.nested_anova(df, model, method=method).orderBy("Model").collect()
    assert [r["df"] for r in found] == [3, 6, 9, 11]
    fits = [mixed.fit_mixed(df, model.restricted(model.factors[:k]), method=method) for k in range(4)]
    for r, fit in zip(found, fits):
        assert r["logLik"] == pytest.approx(fit.loglik, abs=1e-6)
        nobs = fit.n - fit.p if method == "REML" else fit.n
        assert r["AIC"] == pytest.approx(-2 * fit.loglik + 2 * (fit.p + 2), abs=1e-5)
        assert r["BIC"] == pytest.approx(-2 * fit.loglik + np.log(nobs) * (fit.p + 2), abs=1e-5)
    assert found[0]["L_Ratio"] is None
    assert found[2]["L_Ratio"] == pytest.approx(2 * abs(fits[2].loglik - fits[1].loglik), abs=1e-5)


def test_residuals(spark, fitted):
    rows, df, model = fitted
    fit = mixed.fit_mixed(df, model)
    effects = {r["CODIGO_BARRIO"]: r["RAN_EFFECT"] for r in fit.ranef.collect()}
    x, y = dense(rows, model)
    want = y - x @ fit.beta - x[:, 0] * np.array([effects[r[0]] for r in rows])
    got = [r["Residuals"] for r in mixed.with_fitted(df, fit).collect()]
    assert sorted(got) == pytest.approx(sorted(want), abs=1e-6)


def test_term_labels(spark):
    base = "PRECIO_MEAN_ARRIENDO"
    labels = [base, f"{base}:ESTRATO4", f"{base}:CODIGO_LOCALIDAD10", f"{base}:ANO2018"]
    rows = design.parse_terms(spark.createDataFrame([(v,) for v in labels], "rowname string")).collect()
    assert [(r["ESTRATO"], r["CODIGO_LOCALIDAD"], r["ANO"], r["Intercepto"]) for r in rows] == [
        (None, None, None, 1), ("4", None, None, None), (None, "10", None, None), (None, None, "2018", None)]
