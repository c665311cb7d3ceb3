"""The second-sample screen against plain loops."""

import numpy as np
import pytest
from test_control import listings, plain_pass

from rentlens.operators import control, validate
from rentlens.sources import schemas


@pytest.mark.parametrize("repeat", [False, True])
def test_screen(spark, repeat):
    rng = np.random.default_rng(21)
    train = listings(spark)
    base = spark.createDataFrame(
        [(i, y, c, e, o, code, p, v, a, code + "0101", None, "1", "L", "APARTAMENTO", None)
         for i, y, c, e, o, code, p, v, a in train],
        "IDENTIFICADOR string, ANO int, CLASE_PREDIO string, ESTRATO int, TIPO_OFERTA string, CODIGO_BARRIO string, "
        "PRECIO double, VALOR_M2_INTEGRAL double, AREA_CONSTRUIDA double, BARMANPRE string, NOMBRE_BARRIO string, "
        "CODIGO_LOCALIDAD string, NOMBRE_LOCALIDAD string, TIPO_INMUEBLE string, VALOR_ADMINISTRACION string")
    second, rows = [], list(train)
    for k in range(40):
        code = str(rng.choice(["001101", "001102", "001201", "101101"]))  # the last one is rural
        area = float(rng.integers(40, 120))
        sale = float(np.round(area * rng.normal(3e6, 4e5) * rng.choice([1, 1, 5])))
        rent = float(np.round(sale / rng.uniform(150, 250)))
        second.append((f"t{k}", "APARTAMENTO", "P", 2019, 3, code, "01", "02", "0", "1", "L", area, rent, sale, sale))
        if code[0] == "0":
            rows += [(f"t{k}", 2019, "P", 3, offer, code, price, price / area, area)
                     for offer, price in (("ARRIENDO", rent), ("VENTA", sale))]
    kept = plain_pass(plain_pass(rows, control.SINGULAR), control.SINGULAR)
    expected = [r[0] for r in kept if r[0].startswith("t")]
    two_price = spark.createDataFrame(second, schemas.TWO_PRICE)
    census = spark.createDataFrame([], schemas.FEE_CENSUS)
    found = validate.screen_second_sample(two_price, base, census, repeat)
    want = expected if repeat else list(set(expected))
    assert 0 < len(set(expected)) < 40
    assert sorted(r["OFT_CODIGO"] for r in found.collect()) == sorted(want)
