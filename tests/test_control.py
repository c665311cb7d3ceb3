import numpy as np
import pytest
from test_pooling import pools

from rentlens.functions.special import beta_quantile
from rentlens.operators import control
from rentlens.operators.clean import SEGMENT

COLS = control.MEASURES


def frame(spark, groups):
    rows = [(g, *map(float, r)) for g, m in groups.items() for r in m]
    return spark.createDataFrame(rows, "g string, PRECIO double, VALOR_M2_INTEGRAL double, AREA_CONSTRUIDA double")


def plain_chart(x, confidence=0.9, tol=control.SINGULAR):
    """T2 and limit by the definition, with the columns that may be used."""
    x = np.asarray(x, float)
    cols = [j for j in range(x.shape[1]) if x[:, j].min() < x[:, j].max()]
    if len(x) < 2 or not cols:
        return None, None
    while len(cols) > 1:
        s = np.cov(x[:, cols].T)
        with np.errstate(all="ignore"):
            try:
                inverse = np.linalg.inv(s)
                rcond = 1 / (np.abs(s).sum(0).max() * np.abs(inverse).sum(0).max())
            except np.linalg.LinAlgError:
                rcond = 0.0
        if rcond >= tol:
            break
        cols = cols[:-1]
    y = x[:, cols] - x[:, cols].mean(0)
    s = np.atleast_2d(np.cov(x[:, cols].T))
    t2 = np.einsum("ij,jk,ik->i", y, np.linalg.inv(s), y)
    m, p = y.shape
    if m <= p + 1:
        return t2, None
    return t2, (m - 1) ** 2 / m * float(beta_quantile(confidence, p / 2, (m - p - 1) / 2))


def test_against_the_definition(spark):
    rng = np.random.default_rng(3)
    groups = {}
    for k in range(8):
        m = rng.normal(size=(rng.integers(6, 80), 3)) @ rng.normal(size=(3, 3)) * [5, 3, 2] + 50
        groups[f"full{k}"] = m
    const = rng.normal(size=(30, 3)) * 4 + 90
    const[:, 1] = 7.0
    groups["constant column"] = const
    dependent = rng.normal(size=(30, 3)) * 4 + 90
    dependent[:, 2] = 2 * dependent[:, 0] - dependent[:, 1]
    groups["dependent"] = dependent
    chart = control.t2_chart(frame(spark, groups), ["g"], singular_tol=1e-12).collect()
    for g, m in groups.items():
        t2, ucl = plain_chart(m, tol=1e-12)
        rows = [r for r in chart if r["g"] == g]
        assert sorted(r["t2"] for r in rows) == pytest.approx(sorted(t2), rel=1e-6, abs=1e-9)
        assert rows[0]["ucl"] == pytest.approx(ucl, rel=1e-9)
        assert sum(r["is_outlier"] for r in rows) == int((t2 > ucl).sum())
        p = rows[0]["pool_p"]
        assert sum(r["t2"] for r in rows) == pytest.approx(p * (len(m) - 1), rel=1e-6)
    used = {r["g"]: r["pool_p"] for r in chart}
    assert used["constant column"] == 2 and used["dependent"] == 2 and used["full0"] == 3


def test_groups_without_a_limit_keep_all(spark):
    groups = {"one": [[1, 2, 3]], "same": [[5, 5, 5]] * 6, "few": np.random.default_rng(0).normal(size=(4, 3))}
    rows = control.t2_chart(frame(spark, groups), ["g"], singular_tol=0.0).collect()
    assert len(rows) == 11 and not any(r["is_outlier"] for r in rows)
    assert all(r["ucl"] is None for r in rows)


def test_planted_outlier_and_exceedance(spark):
    rng = np.random.default_rng(8)
    m = rng.normal(size=(3000, 3)) + 20
    m[0] = [30, 10, 30]
    rows = control.t2_chart(frame(spark, {"g": m}), ["g"]).collect()
    assert [r["is_outlier"] for r in rows if r["PRECIO"] == 30] == [True]
    assert 0.07 < np.mean([r["is_outlier"] for r in rows]) < 0.13


def test_unit_scale_of_the_singularity_test(spark):
    rng = np.random.default_rng(9)
    m = rng.normal(size=(200, 3)) * [1e9, 1.0, 1.0] + [1e9, 5, 5]
    raw = control.t2_chart(frame(spark, {"g": m}), ["g"]).first()["pool_p"]
    scaled = control.t2_chart(frame(spark, {"g": m}), ["g"], scaled=True).first()["pool_p"]
    assert (raw, scaled) == (1, 3)


def test_merged_moments(spark):
    rng = np.random.default_rng(10)
    rows = [("g", f"s{i % 7}", *map(float, rng.normal(size=3) * [1e6, 10, 1] + [1e8, 50, 60])) for i in range(300)]
    rows.append(("g", "alone", 1.1e8, 51.0, 61.0))
    df = spark.createDataFrame(rows, "g string, s string, PRECIO double, VALOR_M2_INTEGRAL double, "
                                     "AREA_CONSTRUIDA double")
    direct = control.moments(df, ["g"]).first()
    merged = control.merge_moments(control.moments(df, ["g", "s"]), ["g"]).first()
    for c in merged.asDict():
        if c != "g":
            assert merged[c] == pytest.approx(direct[c], rel=1e-9, abs=1e-9), c


def listings(spark, seed=11):
    rng = np.random.default_rng(seed)
    rows = []
    for segment in ((2019, "P", 3, "VENTA"), (2019, "P", 3, "ARRIENDO"), (2020, "N", 1, "VENTA")):
        for code in ("001101", "001102", "001103", "001201", "002101", "009901"):
            for _ in range(int(rng.choice([2, 6, 25, 60]))):
                area = float(rng.integers(40, 120))
                price = float(np.round(area * rng.normal(3e6, 4e5) * rng.choice([1, 1, 1, 1, 6])))
                rows.append((f"{len(rows)}", *segment, code, price, np.floor(price / area).item(), area))
    return rows


SCHEMA = ("IDENTIFICADOR string, ANO int, CLASE_PREDIO string, ESTRATO int, TIPO_OFERTA string, CODIGO_BARRIO string, "
          "PRECIO double, VALOR_M2_INTEGRAL double, AREA_CONSTRUIDA double")


def plain_pass(rows, tol):
    kept = []
    for segment in sorted({r[1:5] for r in rows}):
        own = [r for r in rows if r[1:5] == segment]
        sizes = {}
        for r in own:
            sizes[r[5]] = sizes.get(r[5], 0) + 1
        at = pools(sizes)
        for pool in sorted(set(at.values())):
            members = [r for r in own if at[r[5]] == pool]
            t2, ucl = plain_chart([r[6:9] for r in members], tol=tol)
            kept += [r for i, r in enumerate(members) if ucl is None or t2[i] <= ucl]
    return kept


@pytest.mark.parametrize("tol", [control.SINGULAR, 1e-10])
def test_two_passes_against_plain_loops(spark, tol):
    rows = listings(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    once = plain_pass(rows, tol)
    twice = plain_pass(once, tol)
    assert len(twice) < len(once) < len(rows)
    for passes, expected in ((1, once), (2, twice)):
        found = control.quality_control(df, passes, singular_tol=tol)
        assert sorted(r["IDENTIFICADOR"] for r in found.collect()) == sorted(r[0] for r in expected)


def test_unknown_segment_stays(spark):
    rows = listings(spark) + [("odd", None, "P", 3, "VENTA", "001101", 1e8, 2e6, 50.0)]
    kept = control.quality_control(spark.createDataFrame(rows, SCHEMA), 1)
    assert kept.filter("IDENTIFICADOR = 'odd'").count() == 1


def test_missing_areas_are_filled(spark):
    rows = [(*r[:8], None if i % 9 == 0 else r[8]) for i, r in enumerate(listings(spark))]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = control.quality_control(df, 1)
    assert kept.filter("AREA_CONSTRUIDA IS NULL").count() == 0


def test_numbering(spark):
    rng = np.random.default_rng(12)
    rows = [("big" if rng.random() < 0.8 else f"g{rng.integers(5)}", f"{rng.integers(10**6):06d}", i)
            for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, k string, i int")
    found = control.numbered(df, ["g"], ["k"], "label").collect()
    by_group = {}
    for r in found:
        by_group.setdefault(r["g"], []).append((r["label"], r["k"]))
    for group in by_group.values():
        group.sort()
        assert [label for label, _ in group] == list(range(1, len(group) + 1))
        assert [k for _, k in group] == sorted(k for _, k in group)
    assert SEGMENT == ["ANO", "CLASE_PREDIO", "ESTRATO", "TIPO_OFERTA"]
