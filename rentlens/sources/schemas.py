"""Declared schemas of the inputs."""

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _int, _double = T.StringType(), T.IntegerType(), T.DoubleType()

LISTINGS = _schema(
    IDENTIFICADOR=_text, TIPO_INMUEBLE=_text, TIPO_OFERTA=_text, CLASE_PREDIO=_text, ESTRATO=_int, ANO=_int,
    PRECIO=_text, AREA_CONSTRUIDA=_double, VALOR_M2_INTEGRAL=_double, VALOR_ADMINISTRACION=_text,
    BARMANPRE=_text, CODIGO_BARRIO=_text, NOMBRE_BARRIO=_text, CODIGO_LOCALIDAD=_text,
    NOMBRE_LOCALIDAD=_text, NOMBRE_FUENTE=_text)

CADASTRAL = _schema(
    CODIGO_BARRIO=_text, CLASE_PREDIO=_text, CODIGO_ESTRATO=_int, VIGENCIA=_int, VALOR_INTEGRAL=_double)

FEE_CENSUS = _schema(BARMANPRE_AJUSTADO=_text, ESTRATO=_int, VALOR_ADMINISTRACION_MODA=_double)

TWO_PRICE = _schema(
    OFT_CODIGO=_text, OFT_TIPO_INMUEBLE=_text, CLASE_PREDIO_SIIC=_text, VIGENCIA=_int,
    CODIGO_ESTRATO_SIIC=_int, CODIGO_BARRIO=_text, CODIGO_MANZANA=_text, CODIGO_PREDIO=_text,
    CODIGO_RESTO=_text, CODIGO_LOCALIDAD=_text, NOMBRE_LOCALIDAD=_text, AREA_CONSTRUIDA_SIIC=_double,
    VR_INICIAL_ARRIENDO=_double, VR_INICIAL_VENTA=_double, VR_FINAL_VENTA=_double)

LOCALITY = _schema(CODIGO_LOCALIDAD=_text, NOMBRE_LOCALIDAD=_text)

RATES_SECTOR = _schema(
    OFT_TIPO_INMUEBLE=_text, ANO=_int, CODIGO_LOCALIDAD=_text, ESTRATO=_int, CODIGO_BARRIO=_text,
    TASA_RENTA=_double)

RATES_LOCALITY = _schema(
    OFT_TIPO_INMUEBLE=_text, ANO=_int, CODIGO_LOCALIDAD=_text, ESTRATO=_int, TASA_RENTA=_double)
