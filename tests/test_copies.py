"""Listings kept once with their copies, against the repeated rows they stand for."""

import pytest
from pyspark.sql import functions as F

from rentlens.operators import clean, cohort, control
from rentlens.plans import fixtures
from rentlens.plans.study import Study
from rentlens.sources import schemas

MEASURED = "g string, a double, b double, c double, w long"


def _repeated(df, weight="w"):
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(weight)))).drop("copy")


def test_moments_of_copies(spark):
    rows = [("x", 1.0, 5.0, 7.5, 1), ("x", 2.5, None, 7.5, 3), ("x", 4.0, 2.0, 7.5, 3), ("x", 9.0, 2.5, None, 2),
            ("y", 3.0, 1.0, 2.0, 4), (None, 1.5, 2.5, 0.5, 2), (None, 0.5, 2.0, 4.5, 2), ("z", 3.0, 1.0, None, 1)]
    df = spark.createDataFrame(rows, MEASURED)
    cols = ["a", "b", "c"]
    want = {r["g"]: r.asDict() for r in control.moments(_repeated(df), ["g"], cols).collect()}
    found = {r["g"]: r.asDict() for r in control.moments(df, ["g"], cols, "w").collect()}
    assert found.keys() == want.keys()
    for g in want:
        for name, value in want[g].items():
            got = found[g][name]
            assert got == (value if value is None or name == "g" else pytest.approx(value, rel=1e-12, abs=1e-12)), (g, name)


def _listing(i, code, kind="APARTAMENTO", fee=None, price=1e8):
    return (str(i), kind, "VENTA" if i % 2 else "ARRIENDO", "P", 3, 2019, f"${int(price + i * 1e5)}", 50.0 + i % 7,
            float(2e6 + 1000 * (i * i % 31)), fee, f"{code}0101" if i % 3 else f"{code}0102", code, "N", "1", "L", "s")


def _census(spark, fees):
    rows = [("0011010101", 3, float(20000 + 10 * k)) for k in range(fees)] + [("0011010102", 3, 50000.0)] * 2
    return spark.createDataFrame(rows, schemas.FEE_CENSUS)


LISTING = ("IDENTIFICADOR string, TIPO_INMUEBLE string, TIPO_OFERTA string, CLASE_PREDIO string, ESTRATO int, ANO int, "
           "PRECIO string, AREA_CONSTRUIDA double, VALOR_M2_INTEGRAL double, VALOR_ADMINISTRACION string, BARMANPRE string, "
           "CODIGO_BARRIO string, NOMBRE_BARRIO string, CODIGO_LOCALIDAD string, NOMBRE_LOCALIDAD string, NOMBRE_FUENTE string")


def _listings(spark):
    rows = [_listing(i, "001101" if i % 4 else "001102", "CASA" if i % 5 == 0 else "APARTAMENTO",
                     "$30000" if i % 6 == 0 else None, 9e8 if i == 41 else 1e8) for i in range(60)]
    return spark.createDataFrame(rows, LISTING)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lots_of_many_fees_are_stored_once(spark):
    """Stored steps have a row per listing, whatever the lots' fees; the rows asked for repeat as before."""
    census = _census(spark, 200)
    study = Study(_listings(spark), census, spark.createDataFrame([], schemas.CADASTRAL))
    direct = clean.clean_listings(_listings(spark), census)
    assert study.cleaned.columns == direct.columns and direct.count() > 3000
    assert _sorted(study.cleaned) == _sorted(direct)
    assert study.store.load("cleaned").count() == 60
    kept = control.quality_control(direct)
    assert study.kept.columns == kept.columns and study.kept.count() < direct.count()
    assert _sorted(study.kept) == _sorted(kept)
    assert study.store.load("kept").count() < 60
    want = {r["CODIGO_BARRIO"]: r.asDict() for r in cohort.cohort_table(kept).collect()}
    for r in study.cohorts.collect():
        for name, value in want.pop(r["CODIGO_BARRIO"]).items():
            assert r[name] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value)
    assert not want


def _order_tables(spark, folder):
    """Small order tables, with null keys and repeated rows."""
    tables = {
        "nation": ([(k, f"N{k}") for k in (0, 7, 24)], "n_nationkey int, n_name string"),
        "customer": ([(k, (0, 7, 24)[k % 3], 10.0 * k) for k in range(1, 30)] + [(5, 7, 1.0), (None, 0, 1.0)],
                     "c_custkey long, c_nationkey int, c_acctbal double"),
        "orders": ([(k, 1 + k % 28, 1e5 + k, f"{1 + k % 5}-X", f"199{5 + k % 4}-03-01") for k in range(60)]
                   + [(7, 8, 1.0, "2-X", "1996-01-01"), (None, 3, 1.0, "1-X", None), (61, None, 1.0, None, "1997-01-01")],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, o_orderdate string"),
        "lineitem": ([(k % 62, 1 + k % 4, k % 9, 1.0 + k % 50, 1000.0 + k, k % 11 / 100, k % 9 / 100, "NRA"[k % 3], "OF"[k % 2])
                      for k in range(200)] + [(None, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O"), (5, 1, None, None, None, None, None, None, None)],
                     "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string")}
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
        df.write.parquet(f"{folder}/{name}.parquet")


def test_order_tables_are_joined_once(spark, tmp_path):
    """The views of a query that reads several come from one stored join, with the rows of the SQL."""
    _order_tables(spark, tmp_path)
    t = fixtures.Tables(spark, str(tmp_path))
    names = ("offers", "listings", "cadastral", "ranef")
    lazy = {n: t.view(n) for n in names}
    direct = {n: spark.sql(fixtures.with_views([n], f"SELECT * FROM {n}")) for n in names}
    t.stored_rows
    for n in names:
        found = t.view(n)
        assert found.schema == direct[n].schema and found.count() == direct[n].count() > 0
        for made in (found, lazy[n]):
            assert made.exceptAll(direct[n]).isEmpty() and direct[n].exceptAll(made).isEmpty()
        assert {f.rsplit("/", 2)[-2] for f in found.inputFiles()} == {"rows"}


def test_prices_are_parsed_once(spark, monkeypatch):
    """The price is tested where it is stored: a test ahead of that would parse the text a second time."""
    plans = {}

    def stage(df, label="stage"):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, label)

    store = clean.stage
    monkeypatch.setattr(clean, "stage", stage)
    texts = ["$1,500", "$0", "$-3", "none", None, "Infinity", "$0.5"]
    rows = [("r%d" % k, *_listing(1, "001101")[1:6], text, *_listing(1, "001101")[7:]) for k, text in enumerate(texts)]
    once = clean.clean_once(spark.createDataFrame(rows, LISTING), _census(spark, 2))
    assert {r["IDENTIFICADOR"]: r["PRECIO"] for r in once.collect()} == {"r0": 1500.0, "r6": 0.5}
    filters = [line for line in plans["parsed"].splitlines() if "Filter" in line]
    assert filters and not any("translate(" in line for line in filters)


def _stored(monkeypatch, *modules):
    """Columns of what the modules store, by label, from here on."""
    found = []
    for module in modules:
        def stage(df, label="stage", store=module.stage):
            found.append((label, df.columns))
            return store(df, label)

        monkeypatch.setattr(module, "stage", stage)
    return found


def test_control_stores_limits_and_no_listings(spark, monkeypatch):
    """A pass keeps its limits; the rows are the same as with those of every pass stored."""
    rows = clean.clean_once(_listings(spark), _census(spark, 5))
    with_rows = control.quality_control(rows, cutoff=5, save=control.stage, weight=clean.COPIES)
    want = _sorted(with_rows)
    found = _stored(monkeypatch, control)
    kept = control.quality_control(rows, cutoff=5, weight=clean.COPIES)
    assert kept.columns == with_rows.columns and _sorted(kept) == want and 0 < len(want) < rows.count()
    assert found and not any("IDENTIFICADOR" in columns for _, columns in found)


def test_study_writes_listings_once(spark, monkeypatch):
    """The parsed and joined listings are written once; those kept are read from them until they are asked for."""
    priceless = spark.createDataFrame([("none", *_listing(1, "001101")[1:6], "unknown", *_listing(1, "001101")[7:])], LISTING)
    listings, census = _listings(spark).unionByName(priceless), _census(spark, 3)
    found = _stored(monkeypatch, clean, control)
    study = Study(listings, census, spark.createDataFrame([], schemas.CADASTRAL))
    cohorts = _sorted(study.cohorts)
    study.split.collect()
    assert found and not any("IDENTIFICADOR" in columns for _, columns in found)
    assert "cleaned" in study.store.names and "kept" not in study.store.names
    assert study.cleaned_once.count() == 60 and study.cleaned_once.filter("IDENTIFICADOR = 'none'").isEmpty()
    kept = study.kept_once
    assert "kept" in study.store.names and _sorted(kept) == _sorted(study.controlled)
    again = _sorted(cohort.cohort_table(kept, weight=clean.COPIES))
    assert len(cohorts) == len(again) > 0
    for a, b in zip(again, cohorts):
        assert a == tuple(pytest.approx(v, rel=1e-12) if isinstance(v, float) else v for v in b)


def test_texts_of_an_order_are_made_once(spark, tmp_path):
    """Sector and lot are made with the order, not with each of its items."""
    _order_tables(spark, tmp_path)
    t = fixtures.Tables(spark, str(tmp_path))
    assert {"o_sector", "o_lot"} <= set(t.stored_rows.columns)
    plan = t.view("listings")._jdf.queryExecution().optimizedPlan().toString()
    assert "o_sector" in plan and "lpad(" not in plan
