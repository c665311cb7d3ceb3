"""Listings, census, cadastral and two-price tables derived from the order tables, in SQL both engines run.

Values are whole numbers wherever they are averaged later, so that sums do not depend on their order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from rentlens.sources.store import stage

BASE_TABLES = ("nation", "customer", "orders", "lineitem")

_SECTOR = """concat(CASE WHEN c_nationkey = 24 THEN '1' ELSE '0' END,
    lpad(cast(c_nationkey * 100 + {key} % 5 as string), 5, '0'))"""
_LOT = "lpad(cast(cast(({key} - {key} % 5) / 5 as bigint) as string), 4, '0')"
_O_SECTOR, _O_LOT = _SECTOR.format(key="o_custkey"), _LOT.format(key="o_custkey")
_C_SECTOR, _C_LOT = _SECTOR.format(key="c_custkey"), _LOT.format(key="c_custkey")
_PRICE = "round(l_extendedprice * (CASE WHEN l_linestatus = 'O' THEN 10000 ELSE 50 END), 0)"

VIEWS = {
    "offers": f"""
SELECT cast(l_orderkey * 10 + l_linenumber as string) AS IDENTIFICADOR,
  concat('$', cast(cast({_PRICE} as bigint) as string)) AS PRECIO_TXT,
  {_PRICE} AS PRECIO,
  CASE WHEN l_tax >= 0.075 THEN NULL ELSE l_quantity + 60 END AS AREA_CONSTRUIDA,
  CASE WHEN l_tax >= 0.075 THEN NULL ELSE cast(floor({_PRICE} / (l_quantity + 60)) as double) END AS VALOR_M2_INTEGRAL,
  {_O_SECTOR} AS CODIGO_BARRIO,
  concat('SECTOR ', {_O_SECTOR}) AS NOMBRE_BARRIO,
  CASE WHEN l_discount >= 0.095 THEN NULL ELSE concat({_O_SECTOR}, {_O_LOT}) END AS BARMANPRE,
  cast(c_nationkey as string) AS CODIGO_LOCALIDAD, n_name AS NOMBRE_LOCALIDAD,
  CASE WHEN l_returnflag = 'N' THEN 'P' ELSE 'N' END AS CLASE_PREDIO,
  CASE WHEN l_returnflag = 'N' THEN 'APARTAMENTO' ELSE 'CASA' END AS TIPO_INMUEBLE,
  cast(substr(o_orderpriority, 1, 1) as int) AS ESTRATO,
  cast(2017 + (year(o_orderdate) - 1995) % 4 as int) AS ANO,
  CASE WHEN l_linestatus = 'O' THEN 'VENTA' ELSE 'ARRIENDO' END AS TIPO_OFERTA,
  CASE WHEN l_tax < 0.025 THEN NULL ELSE round(l_extendedprice * 4 * l_tax, 0) END AS VALOR_ADMINISTRACION,
  concat('src', cast(l_suppkey % 4 as string)) AS NOMBRE_FUENTE
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey""",

    # raw text form: money as text, codes without their leading zeros
    "listings": """
SELECT IDENTIFICADOR, TIPO_INMUEBLE, TIPO_OFERTA, CLASE_PREDIO, ESTRATO, ANO, PRECIO_TXT AS PRECIO,
  AREA_CONSTRUIDA, VALOR_M2_INTEGRAL,
  CASE WHEN VALOR_ADMINISTRACION IS NULL THEN NULL
    ELSE concat('$', cast(cast(VALOR_ADMINISTRACION as bigint) as string), '.00') END AS VALOR_ADMINISTRACION,
  cast(cast(BARMANPRE as bigint) as string) AS BARMANPRE,
  cast(cast(CODIGO_BARRIO as int) as string) AS CODIGO_BARRIO,
  NOMBRE_BARRIO, CODIGO_LOCALIDAD, NOMBRE_LOCALIDAD, NOMBRE_FUENTE
FROM offers""",

    "cadastral": """
SELECT CODIGO_BARRIO, CLASE_PREDIO, ESTRATO AS CODIGO_ESTRATO, ANO AS VIGENCIA,
  cast(floor(avg(cast(floor(PRECIO * (CASE WHEN TIPO_OFERTA = 'VENTA' THEN 1 ELSE 200 END)
    / (AREA_CONSTRUIDA + 1)) as double))) as double) AS VALOR_INTEGRAL
FROM offers WHERE AREA_CONSTRUIDA IS NOT NULL
GROUP BY CODIGO_BARRIO, CLASE_PREDIO, ESTRATO, ANO""",

    "fee_census": f"""
SELECT concat({_C_SECTOR}, {_C_LOT}) AS BARMANPRE_AJUSTADO,
  cast(1 + c_custkey % 4 as int) AS ESTRATO, round(abs(c_acctbal) * 30, 0) AS VALOR_ADMINISTRACION_MODA
FROM customer WHERE c_custkey % 3 <> 0""",

    "locality": "SELECT cast(n_nationkey as string) AS CODIGO_LOCALIDAD, n_name AS NOMBRE_LOCALIDAD FROM nation",

    "two_price": f"""
SELECT cast(o_orderkey as string) AS OFT_CODIGO,
  CASE WHEN o_orderkey % 2 = 0 THEN 'APARTAMENTO' ELSE 'CASA' END AS OFT_TIPO_INMUEBLE,
  CASE WHEN o_orderkey % 2 = 0 THEN 'P' ELSE 'N' END AS CLASE_PREDIO_SIIC,
  cast(2017 + (year(o_orderdate) - 1995) % 4 as int) AS VIGENCIA,
  cast(substr(o_orderpriority, 1, 1) as int) AS CODIGO_ESTRATO_SIIC,
  {_O_SECTOR} AS CODIGO_BARRIO,
  cast(o_custkey % 100 as string) AS CODIGO_MANZANA, cast(o_orderkey % 100 as string) AS CODIGO_PREDIO,
  cast(o_orderkey % 7 as string) AS CODIGO_RESTO,
  cast(c_nationkey as string) AS CODIGO_LOCALIDAD, n_name AS NOMBRE_LOCALIDAD,
  cast(40 + o_orderkey % 90 as double) AS AREA_CONSTRUIDA_SIIC,
  round(o_totalprice * 8 * (3 + o_orderkey % 11) / 3, 0) AS VR_INICIAL_ARRIENDO,
  round(o_totalprice * 3000, 0) AS VR_INICIAL_VENTA,
  round(o_totalprice * (2990 - o_orderkey % 97), 0) AS VR_FINAL_VENTA
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",

    # model outputs with fixed values, so that later steps have an exact answer
    "coefs": """
SELECT 'all' AS FACTOR, '' AS NIVEL, cast(200 as double) AS COEF
UNION ALL SELECT 'est', cast(n_nationkey + 2 as string), cast(2.5 * (n_nationkey + 1) as double)
  FROM nation WHERE n_nationkey < 4
UNION ALL SELECT 'loc', cast(n_nationkey as string), cast(0.75 * n_nationkey as double)
  FROM nation WHERE n_nationkey BETWEEN 1 AND 23
UNION ALL SELECT 'year', cast(n_nationkey + 2018 as string), cast(-1.25 * (n_nationkey + 1) as double)
  FROM nation WHERE n_nationkey < 3""",

    "ranef": """
SELECT DISTINCT CODIGO_BARRIO, cast((cast(CODIGO_BARRIO as int) % 13) - 6 as double) AS RAN_EFFECT
FROM offers WHERE substr(CODIGO_BARRIO, 1, 1) = '0'""",

    "rates_sector": """
SELECT DISTINCT OFT_TIPO_INMUEBLE, VIGENCIA AS ANO, CODIGO_LOCALIDAD, CODIGO_ESTRATO_SIIC AS ESTRATO, CODIGO_BARRIO,
  cast(0.004 + 0.0001 * CODIGO_ESTRATO_SIIC + 0.00001 * (VIGENCIA - 2017) as double) AS TASA_RENTA
FROM two_price WHERE substr(CODIGO_BARRIO, 1, 1) = '0' AND cast(CODIGO_BARRIO as int) % 3 <> 0""",

    "rates_locality": """
SELECT DISTINCT OFT_TIPO_INMUEBLE, VIGENCIA AS ANO, CODIGO_LOCALIDAD, CODIGO_ESTRATO_SIIC AS ESTRATO,
  cast(0.005 + 0.0001 * CODIGO_ESTRATO_SIIC as double) AS TASA_RENTA
FROM two_price WHERE CODIGO_LOCALIDAD <> '24'""",
}

# the rows that "offers" is made of: the small tables are joined to the orders before the line items are, and the texts that
# depend on the order alone are made there, once for all its items
_JOIN = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey"""
_OFFER_ROWS = f"""
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  o_sector, o_lot, o_orderdate, o_orderpriority, c_nationkey, n_name
FROM lineitem JOIN (SELECT o_orderkey, {_O_SECTOR} AS o_sector, {_O_LOT} AS o_lot, o_orderdate, o_orderpriority,
    c_nationkey, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) ON l_orderkey = o_orderkey"""

_NEEDS = {"listings": ["offers"], "cadastral": ["offers"], "ranef": ["offers"],
          "rates_sector": ["two_price"], "rates_locality": ["two_price"]}


def with_views(names: list[str], query: str, views: dict[str, str] = VIEWS) -> str:
    """``query`` behind the WITH clause that defines ``names`` and what they need."""
    order: list[str] = []
    for name in names:
        for needed in (*_NEEDS.get(name, []), name):
            if needed not in order:
                order.append(needed)
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in order) + "\n" + query


class Tables:
    """The views as DataFrames over one folder of base tables. Nothing is read until used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def base(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def view(self, name: str) -> DataFrame:
        for table in BASE_TABLES:
            self.base(table).createOrReplaceTempView(table)
        offers = VIEWS["offers"].replace(_JOIN, "FROM {rows}").replace(_O_SECTOR, "o_sector").replace(_O_LOT, "o_lot")
        views = VIEWS | {"offers": offers}
        rows = self.stored_rows if "stored_rows" in vars(self) else self.spark.sql(_OFFER_ROWS)
        args = {"rows": rows} if "offers" in (name, *_NEEDS.get(name, [])) else {}
        return self.spark.sql(with_views([name], f"SELECT * FROM {name}", views), **args)

    @cached_property
    def stored_rows(self) -> DataFrame:
        """The rows behind the offers as a stage table, for queries that read several of the views made of them; views
        asked for later read it, and so join the order tables once."""
        for table in BASE_TABLES:
            self.base(table).createOrReplaceTempView(table)
        return stage(self.spark.sql(_OFFER_ROWS), "offer-rows")

    offers = cached_property(lambda self: self.view("offers"))
    listings = cached_property(lambda self: self.view("listings"))
    cadastral = cached_property(lambda self: self.view("cadastral"))
    fee_census = cached_property(lambda self: self.view("fee_census"))
    locality = cached_property(lambda self: self.view("locality"))
    two_price = cached_property(lambda self: self.view("two_price"))
    coefs = cached_property(lambda self: self.view("coefs"))
    ranef = cached_property(lambda self: self.view("ranef"))
    rates_sector = cached_property(lambda self: self.view("rates_sector"))
    rates_locality = cached_property(lambda self: self.view("rates_locality"))
