import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentlens.functions import special, text
from rentlens.functions import quantiles
from rentlens.functions.quantiles import exact_medians, exact_quantiles, lattice_quantiles


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr).first()[0]


@pytest.mark.parametrize("raw, value", [("$1,234", 1234.0), ("", None), ("abc", None), ("$5.50", 5.5), (None, None)])
def test_money(spark, raw, value):
    assert one(spark, text.parse_money(F.col("x")), x=raw) == value


@pytest.mark.parametrize("raw, value", [("$10,000.00", None), ("$10,001.00", 10001.0), ("10001", 10001.0),
                                        ("", None), ("12,500", 12500.0)])
def test_fee(spark, raw, value):
    assert one(spark, text.parse_fee(F.col("x")), x=raw) == value


@pytest.mark.parametrize("raw, value", [("7", "000007"), ("1234567", "1234567"), ("123456", "123456"), (None, None)])
def test_pad(spark, raw, value):
    assert one(spark, text.pad_left(F.col("x"), 6), x=raw) == value


@pytest.mark.parametrize("raw, value", [("1101.0", "1101"), ("1101", "1101"), ("110.05", "110.05")])
def test_strip_decimal(spark, raw, value):
    assert one(spark, text.strip_decimal(F.col("x")), x=raw) == value


def test_similarity_and_prefix(spark):
    assert one(spark, text.code_similarity(F.col("a"), F.col("b")), a="001101", b="001102") == pytest.approx(5 / 6)
    assert one(spark, text.common_prefix_length(F.col("a"), F.col("b")), a="001101", b="001102") == 5
    assert one(spark, text.common_prefix_length(F.col("a"), F.col("b")), a="101101", b="001102") == 0
    assert one(spark, text.common_prefix_length(F.col("a"), F.col("b")), a="00", b="001102") == 2


def test_thousands(spark):
    assert one(spark, text.format_thousands(F.col("x")), x=1234567.0) == "1.234.567"


def test_band_ends(spark):
    banded = text.band(F.col("x"), [0.0, 3.0, 5.0], ["low", "high"], "none")
    assert [one(spark, banded, x=v) for v in (0.0, 0.1, 3.0, 3.1, 5.0, 5.1)] == [
        "none", "low", "none", "high", "none", "none"]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], ["Año", "Venta_ estimado", "codigoBarrio", "2019", "año"])
    assert text.normalise_names(df).columns == ["ANO", "VENTA_ESTIMADO", "CODIGO_BARRIO", "X2019", "ANO_2"]


def _beta_by_sum(x, a, b):
    """Integral of the density by the midpoint rule in t with x = t^2, which tames a = 1/2."""
    t = (np.arange(400000) + 0.5) / 400000 * math.sqrt(x)
    step = math.sqrt(x) / 400000
    norm = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
    return norm * float((2 * t * t ** (2 * a - 2) * (1 - t * t) ** (b - 1)).sum()) * step


@pytest.mark.parametrize("a, b, x", [(0.5, 3.0, 0.2), (1.0, 7.5, 0.1), (1.5, 4.5, 0.3), (1.5, 60.0, 0.04)])
def test_beta_cdf(a, b, x):
    assert float(special.beta_cdf(x, a, b)) == pytest.approx(_beta_by_sum(x, a, b), rel=1e-6)


@settings(max_examples=50, deadline=None)
@given(st.floats(0.01, 0.99), st.sampled_from([0.5, 1.0, 1.5]), st.floats(0.5, 5000.0))
def test_beta_quantile_inverts(p, a, b):
    assert float(special.beta_cdf(special.beta_quantile(p, a, b), a, b)) == pytest.approx(p, abs=1e-9)


def test_beta_cdf_converges_or_fails(monkeypatch):
    for n in (1e3, 1e5, 1e7):  # symmetric, and the slowest place: about the root of n terms
        assert float(special.beta_cdf(0.5, n, n)) == pytest.approx(0.5, abs=1e-7)
    assert np.isnan(special.beta_cdf([0.5, np.nan], 1.5, 20.0)).tolist() == [False, True]
    monkeypatch.setattr(special, "TERMS", 5)
    with pytest.raises(ArithmeticError):
        special.beta_cdf(0.5, 1e5, 1e5)


def test_entry_without_a_library_of_the_subpackage():
    """The other queries stay where something that only the subpackage needs cannot be imported."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['xxhash'] = sys.modules['tokenizers'] = sys.modules['public_tokenizers'] = None; "
            "import __spark_entry__ as e; from rentlens.plans.catalogue import QUERIES; "
            "assert set(QUERIES) == set(e.queries()) and set(e.oracle_sql()) <= set(QUERIES)")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_beta_quantile_without_freedom():
    assert np.isnan(special.beta_quantile(0.9, 1.0, 0.0)) and np.isnan(special.beta_quantile(0.9, 1.0, -1.5))


@pytest.mark.parametrize("x, df, p", [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05),
                                      (5.991464547107979, 2, 0.05), (0.0, 4, 1.0)])
def test_chi2_tail(x, df, p):
    assert special.chi2_tail(x, df) == pytest.approx(p, rel=1e-9)


PROBS = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]


def _check(spark, rows, by):
    df = spark.createDataFrame(rows, "g string, h int, x double")
    found = {tuple(r[c] for c in by): r["x_q"]
             for r in exact_quantiles(df, by, ["x"], PROBS).collect()}
    groups = {}
    for r in rows:
        group = groups.setdefault(tuple({"g": r[0], "h": r[1]}[c] for c in by), [])
        if r[2] is not None and not math.isnan(r[2]):
            group.append(r[2])
    assert set(found) == set(groups)
    for key, values in groups.items():
        if not values:
            assert found[key] is None
            continue
        assert found[key] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("size", [quantiles.SLICE, 700])
def test_quantiles_of_uneven_groups(spark, monkeypatch, size):
    monkeypatch.setattr(quantiles, "SLICE", size)  # the same over one slice and over many
    rnd = random.Random(4)
    rows = [("a", 1, rnd.gauss(0, 1)) for _ in range(4000)]
    rows += [(None, 2, rnd.choice([1.0, 2.0, 3.0])) for _ in range(900)]        # few distinct values, null key
    rows += [("c", None, math.exp(rnd.uniform(-300, 300))) for _ in range(1500)]  # values over 260 decades
    rows += [("d", 4, 7.5) for _ in range(300)]                                 # one value
    rows += [("e", 5, rnd.random()) for _ in range(20)] + [("e", 5, None)]      # small group
    rows += [("f", 6, None)] * 3                                                # no value at all
    rows += [("g", 7, float("nan")), ("g", 7, 1.0), ("g", 7, 2.0)]
    rnd.shuffle(rows)
    _check(spark, rows, ["g", "h"])
    _check(spark, rows, ["g"])
    _check(spark, rows, [])


def test_quantiles_with_infinite_values(spark):
    rows = [("a", float("inf")), *[("a", float(i)) for i in range(50)], ("b", float("-inf")), ("b", float("inf"))]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {r["g"]: r["x_q"] for r in exact_quantiles(df, ["g"], ["x"], [0.0, 0.5, 0.99, 1.0]).collect()}
    assert found["a"] == [0.0, 25.0, float("inf"), float("inf")]
    assert found["b"][0] == float("-inf") and found["b"][3] == float("inf")


def test_adjacent_doubles(spark):
    a = 1.0
    b = math.nextafter(a, 2.0)
    _check(spark, [("a", 1, v) for v in [a] * 30 + [b] * 31], ["g"])


@pytest.mark.parametrize("size", [quantiles.SLICE, 50])
def test_lattice_of_groupings(spark, monkeypatch, size):
    monkeypatch.setattr(quantiles, "SLICE", size)
    rnd = random.Random(11)
    rows = [(rnd.choice("ab"), rnd.choice([1, 2, None]), rnd.choice([0.0, -0.0, 5.0, rnd.random()]), rnd.choice(["y", None]))
            for _ in range(800)]
    rows += [("c", 9, None, "y")] * 2
    df = spark.createDataFrame(rows, "g string, h int, x double, named string")
    levels = {"both": ["g", "h"], "g": ["g"], "h": ["h"], "all": []}
    found = {(r["LEVEL"], r["g"], r["h"]): r for r in lattice_quantiles(df, levels, ["x"], PROBS, "named").collect()}
    wanted = {}
    for g, h, x, named in rows:
        for level, key in (("both", (g, h)), ("g", (g, None)), ("h", (None, h)), ("all", (None, None))):
            wanted.setdefault((level, *key), []).append((x, named))
    assert set(found) == set(wanted)
    for key, members in wanted.items():
        values = [x for x, _ in members if x is not None]
        assert found[key]["N"] == sum(named is not None for _, named in members)
        assert (found[key]["x_q"] is None) if not values else found[key]["x_q"] == pytest.approx(list(np.quantile(values, PROBS)))
    assert lattice_quantiles(df.limit(0), levels, ["x"], PROBS).count() == 0


def test_a_huge_group_is_ranked_slice_by_slice(spark, monkeypatch):
    """A group of all rows: the slices in which no quantile lies are counted, not sorted."""
    monkeypatch.setattr(quantiles, "SLICE", 1000)
    df = spark.range(20_000).selectExpr("id % 7 AS k", "cast((id * 7919) % 20011 AS double) AS x")
    exact = df.toPandas()["x"].to_numpy()
    assert exact_quantiles(df, [], ["x"], PROBS).first()["x_q"] == pytest.approx(list(np.quantile(exact, PROBS)))


def test_medians_of_two_columns(spark):
    rnd = random.Random(5)
    rows = [("a", rnd.random(), rnd.random() * 10) for _ in range(501)] + [("b", 1.0, None)] * 3
    df = spark.createDataFrame(rows, "g string, x double, y double")
    found = {r["g"]: (r["mx"], r["my"]) for r in exact_medians(df, ["g"], {"x": "mx", "y": "my"}).collect()}
    assert found["a"] == pytest.approx((np.median([r[1] for r in rows[:501]]), np.median([r[2] for r in rows[:501]])))
    assert found["b"][1] is None


@pytest.mark.parametrize("m", [10, 1000, 1e6, 1e8, 1e10, 1e12])
def test_beta_quantile_of_huge_pools(m):
    # two measures have a closed form
    exact = -np.expm1(2 / (m - 3) * np.log(0.1))
    assert float(special.beta_quantile(0.9, 1.0, (m - 3) / 2)) == pytest.approx(exact, rel=1e-12)


@pytest.mark.parametrize("p, limit", [(1, 2.705543454095404), (3, 6.251388631170325)])
def test_beta_quantile_tends_to_chi_square(p, limit):
    m = 1e12
    found = float(special.beta_quantile(0.9, p / 2, (m - p - 1) / 2)) * (m - 1) ** 2 / m
    assert found == pytest.approx(limit, rel=1e-11)
