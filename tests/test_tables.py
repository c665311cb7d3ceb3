"""Cleaning and cohort edge cases, rates, readers, sinks, and the stage store."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators import clean, cohort, rates, validate
from rentlens.plans.fixtures import Tables
from rentlens.plans.study import Study
from rentlens.sources.publication import Publication
from rentlens.sources import schemas, store, tables

LISTING = dict(IDENTIFICADOR="1", TIPO_INMUEBLE="APARTAMENTO", TIPO_OFERTA="ARRIENDO", CLASE_PREDIO="P", ESTRATO=3,
               ANO=2019, PRECIO="$1,000,000", AREA_CONSTRUIDA=50.0, VALOR_M2_INTEGRAL=20000.0,
               VALOR_ADMINISTRACION=None, BARMANPRE="12340101", CODIGO_BARRIO="1234", NOMBRE_BARRIO="B",
               CODIGO_LOCALIDAD="1", NOMBRE_LOCALIDAD="L", NOMBRE_FUENTE="s")


def listings(spark, *changes):
    rows = [tuple({**LISTING, **c}[f.name] for f in schemas.LISTINGS) for c in changes]
    return spark.createDataFrame(rows, schemas.LISTINGS)


def census(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.FEE_CENSUS)


def test_exclusions(spark):
    bad = [dict(CODIGO_BARRIO="102400"), dict(AREA_CONSTRUIDA=None), dict(AREA_CONSTRUIDA=0.0),
           dict(BARMANPRE=None), dict(BARMANPRE=""), dict(BARMANPRE="  "), dict(ESTRATO=0), dict(PRECIO="abc"),
           dict(PRECIO="0"), dict(CODIGO_BARRIO=None)]
    good = [dict(), dict(CODIGO_BARRIO="001234", BARMANPRE="0012340101")]
    found = clean.clean_listings(listings(spark, *bad, *good), census(spark)).collect()
    assert [(r["CODIGO_BARRIO"], r["BARMANPRE"], r["PRECIO"]) for r in found] == [
        ("001234", "0012340101", 1e6)] * 2


FEES = [("0012340101", 3, 50000.0), ("0012340202", 3, 30000.0), ("0012340303", 4, 90000.0), ("0099990101", 1, 7.0)]


@pytest.mark.parametrize("change, fee", [
    (dict(VALOR_ADMINISTRACION="$80,000.00"), 80000.0),                # own
    (dict(VALOR_ADMINISTRACION="$10,000.00"), 50000.0),                # own too low: lot
    (dict(), 50000.0),                                                  # lot
    (dict(BARMANPRE="12349999"), 40000.0),                              # median of sector and stratum
    (dict(BARMANPRE="12349999", ESTRATO=5), 50000.0),                   # median of the sector
    (dict(BARMANPRE="55550101", CODIGO_BARRIO="5555"), 0.0),            # unknown sector
    (dict(TIPO_INMUEBLE="CASA", VALOR_ADMINISTRACION="$80,000.00"), 0.0),
])
def test_fee_order(spark, change, fee):
    row = clean.clean_listings(listings(spark, change), census(spark, *FEES)).first()
    assert row["VALOR_ADMON"] == fee
    assert row["VALOR_ADMON_IPC"] == pytest.approx(fee * 1.0349)
    assert row["PRECIO"] == 1e6


def test_repeated_census_rows_do_not_repeat_listings(spark):
    assert clean.clean_listings(listings(spark, {}), census(spark, *FEES, *FEES)).count() == 1
    conflict = clean.lots_with_several_fees(census(spark, *FEES, ("0012340101", 3, 1.0)))
    assert [(r["BARMANPRE"], r["FEES"]) for r in conflict.collect()] == [("0012340101", 2)]


def test_net_price_and_deflators(spark):
    row = clean.clean_listings(listings(spark, {}), census(spark, *FEES), net_of_fee=True).first()
    assert row["PRECIO"] == pytest.approx(1e6 - 50000 * 1.0349)
    late = listings(spark, dict(ANO=2031))
    assert clean.clean_listings(late, census(spark, *FEES)).first()["VALOR_ADMON_IPC"] == 50000.0
    assert clean.clean_listings(late, census(spark, *FEES), default_deflator=0.0).first()["VALOR_ADMON_IPC"] == 0.0


def test_group_mean_fills_unknown_groups_too(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0), (None, None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = sorted(clean.fill_group_mean(df, ["x"], ["g"]).collect(), key=str)
    assert sorted((r["g"] or "", r["x"] or -1.0) for r in found) == [
        ("", 5.0), ("", 5.0), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", -1.0)]


def test_ratio_ends(spark):
    rows = [("a", 1.0, 100.0), ("b", 1.0, 300.0), ("c", None, 200.0), ("d", 1.0, 299.999), ("e", 1.0, 99.0),
            ("f", 1.0, 301.0), ("g", 0.0, 10.0)]
    df = spark.createDataFrame(rows, "k string, PRECIO_MEAN_ARRIENDO double, PRECIO_MEAN_VENTA double")
    found = {r["k"]: r["SPLIT"] for r in cohort.split_by_ratio(df).collect()}
    assert found == {"a": "in", "b": None, "c": None, "d": "in", "e": "out", "f": "out", "g": None}


def test_cohorts_with_one_offer_type(spark):
    sales = [dict(TIPO_OFERTA="VENTA", CODIGO_BARRIO="7", VALOR_M2_INTEGRAL=float(i)) for i in range(6)]
    few = [dict(TIPO_OFERTA="VENTA", CODIGO_BARRIO="8")] * 5
    df = clean.clean_listings(listings(spark, {}, *sales, *few), census(spark))
    found = {r["CODIGO_BARRIO"]: r for r in cohort.cohort_table(df).collect()}
    assert set(found) == {"001234", "000007"}
    assert found["000007"]["N_ARRIENDO"] is None and found["000007"]["N_VENTA"] == 6
    assert found["000007"]["PRECIO_MEAN_VENTA"] == 2.5 and found["001234"]["PRECIO_MEAN_VENTA"] is None


def test_rates_without_effect_or_level(spark):
    cohorts = spark.createDataFrame([("a", "1", 2017, 1), ("b", "2", 2018, 2)] * 2,
                                    "CODIGO_BARRIO string, CODIGO_LOCALIDAD string, ANO int, ESTRATO int")
    coefs = spark.createDataFrame([("all", "", 200.0), ("est", "2", 5.0), ("loc", "2", None)],
                                  "FACTOR string, NIVEL string, COEF double")
    ranef = spark.createDataFrame([("a", 1.5)], "CODIGO_BARRIO string, RAN_EFFECT double")
    found = {r["CODIGO_BARRIO"]: r for r in rates.rate_table(cohorts, coefs, ranef).collect()}
    assert found["a"]["TASA_RENTA"] == 201.5
    assert found["b"]["TASA_RENTA"] is None and found["b"]["Coef_est"] == 5.0 and found["b"]["Coef_loc"] == 0.0
    stratum = {r["ESTRATO"]: (r["TASA_RENTA"], r["TASA_RENTA_2"])
               for r in rates.rates_by_stratum(rates.rate_table(cohorts, coefs, ranef)).collect()}
    assert stratum == {1: (200.0, 0.005), 2: (205.0, 0.0049)}


def test_lot_id_widths(spark):
    df = spark.createDataFrame([("001234", "5", "123")], "CODIGO_BARRIO string, CODIGO_MANZANA string, "
                                                         "CODIGO_PREDIO string")
    assert validate.with_lot_id(df).first()["BARMANPRE"] == "00123405123"


def test_delimited_round_trip(spark, tmp_path):
    df = listings(spark, {}, dict(PRECIO=None), dict(NOMBRE_BARRIO='a "b"\tc, d'))
    tables.write_csv(df, f"{tmp_path}/x.tab", "\t")
    assert sorted(map(str, tables.read_listings(spark, f"{tmp_path}/x.tab").collect())) == sorted(map(str, df.collect()))


def test_rejected_lines(spark, tmp_path):
    kind = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    lines = ["a;b;c", "1;x;2.5", ";;", "one;x;2", "2;y", "3;y;1;1", "4;z;1,5", "x;y;z", '5;"q;q";1', "", "6;caf\u00e9;1"]
    good = "\n".join(lines).encode() + b"\n7;caf\xe9;1\n"
    (tmp_path / "x.csv").write_bytes(good)
    kept, out = tables.read_checked(spark, str(tmp_path / "x.csv"), kind, ";")
    assert kept.count() == 4 and sorted(map(tuple, kept.collect()), key=str) == [
        (1, "x", 2.5), (5, "q;q", 1.0), (6, "caf\u00e9", 1.0), (None, None, None)]
    found = {r["LINEA"]: (r["a"], r["b"], r["c"], r["MOTIVOS"]) for r in out.collect()}
    last = found.pop("7;caf\ufffd;1.0")
    assert last[3] == ["CODIFICACION"]
    assert found == {"one;x;2": (None, "x", 2.0, ["a"]), "2;y": (2, "y", None, ["CAMPOS"]),
                     "3;y;1;1": (3, "y", 1.0, ["CAMPOS"]), "4;z;1,5": (4, "z", None, ["c"]), "x;y;z": (None, "y", None, ["a", "c"])}
    assert dict(tables.rejected_counts(out).collect()) == {"a": 2, "c": 2, "CAMPOS": 2, "CODIFICACION": 1}


def test_rejected_lines_in_another_encoding(spark, tmp_path):
    kind = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (tmp_path / "x.tab").write_bytes("1\tcaf\u00e9\n".encode("latin-1"))
    kept, out = tables.read_checked(spark, str(tmp_path / "x.tab"), kind, header=False, encoding="ISO-8859-1")
    assert [tuple(r) for r in kept.collect()] == [(1, "caf\u00e9")] and out.count() == 0
    (tmp_path / "none.tab").write_bytes(b"")
    kept, out = tables.read_checked(spark, str(tmp_path / "none.tab"), kind)
    assert kept.count() == out.count() == 0


def test_sheet_round_trip(spark, tmp_path):
    df = census(spark, *FEES)
    df.toDF("Barmanpre ajustado", "Estrato", "valor_administracion_moda").write.parquet(f"{tmp_path}/sheet")
    again = tables.read_table(spark, f"{tmp_path}/sheet", schemas.FEE_CENSUS)
    assert again.schema == df.schema and sorted(again.collect()) == sorted(df.collect())
    df.write.option("header", True).csv(f"{tmp_path}/sheet.csv")
    assert sorted(tables.read_table(spark, f"{tmp_path}/sheet.csv", schemas.FEE_CENSUS).collect()) == sorted(df.collect())


def test_store(spark):
    s = store.Store(spark, "t")
    df = s.save(spark.range(5).withColumn("k", F.lit("x")), "five")
    assert s.names == ["five"] and sorted(df.collect()) == sorted(s.load("five").collect())
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        s.save(spark.range(1), "five")


def test_store_reads_the_checkpoint_setting(spark, tmp_path, monkeypatch):
    # the setting is fixed when a session starts, so the test answers in its place
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: f"{tmp_path}/shared")
    assert store.Store(spark).root.startswith(f"{tmp_path}/shared/")


def test_study_publishes_and_writes(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    study = Study(t.listings, t.fee_census, t.cadastral)
    for _ in range(2):  # a second publication replaces the first
        study.publish(f"{tmp_path}/rates")
    for level, want in (("sectores", study.sector_rates), ("localidades", study.locality_rates)):
        found = tables.read_published(spark, f"{tmp_path}/rates", level).withColumnRenamed("CLASE", "CLASE_PREDIO")
        assert sorted(map(repr, found.select(want.columns).collect())) == sorted(map(repr, want.collect()))
        assert {r["CLASE_PREDIO"] for r in found.collect()} == set("PN")
    assert {"cleaned", "cohorts", "imputed", "split", "pruned_P", "rates_N"} <= set(study.store.names)
    tables.write_csv(study.kept, f"{tmp_path}/kept.csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/kept.csv").count() == study.kept.count()
    rates = Publication(spark, f"{tmp_path}/rates")
    rates.check()  # the order of all four tables, from their files
    assert rates.versions() == [1, 2] and rates.manifest()["estratos"]["keys"] == ["CLASE", "ESTRATO", "A"]
    assert rates.read("resumen_localidades").count() == sum(c.by_locality.count() for c in study.classes.values())
    assert [study.write(t.two_price, f"{tmp_path}/tables") for _ in range(2)] == [1, 2]  # it can be run again
    written = Publication(spark, f"{tmp_path}/tables")
    written.check()
    found = {name: written.read(name) for name in (
        "DEPURADA", "BASE_FINAL", "RESUMEN", "RESUMEN_CP", "RESUMEN_LOC", "RESUMEN_EST", "SOBREVIVIENTES")}
    assert found["DEPURADA"].count() == study.cleaned.count()
    assert 0 < found["RESUMEN_CP"].count() <= 2
    assert found["RESUMEN"].agg({"NUM_PREDIOS": "sum"}).first()[0] == found["BASE_FINAL"].count() > 0
    assert 0 < found["SOBREVIVIENTES"].count() < t.two_price.count()
    study.close()
    assert not os.path.exists(study.store.root.removeprefix("file:"))
    assert found["RESUMEN_EST"].count() > 0  # what was published stays
