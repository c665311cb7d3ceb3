"""Readers and sinks. Workbook sheets and SAS tables are expected as parquet or delimited text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions.text import normalise_names
from rentlens.sources import schemas
from rentlens.sources.publication import RANK, Ordered, Publication
from rentlens.sources.store import stage


RATE_KEYS = ["OFT_TIPO_INMUEBLE", "ANO", "CODIGO_LOCALIDAD", "ESTRATO", "CODIGO_BARRIO"]


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Text with a header line. Columns are taken by position, so accents in the header do not matter."""
    return (spark.read.schema(schema).option("sep", sep).option("header", True)
            .option("enforceSchema", True).csv(path))


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated listings."""
    return read_delimited(spark, path, schemas.LISTINGS)


LINE, REASONS = "LINEA", "MOTIVOS"
FIELDS, ENCODING = "CAMPOS", "CODIFICACION"  #: reasons that are not a column: number of fields, bytes that the encoding lacks


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t", header: bool = True,
                 encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """Rows that follow the schema, and the rejected lines with the line (LINEA) and what is wrong with it (MOTIVOS).

    A line is rejected where a field is no value of its column's type (the reason is the column's name; fields that can be read
    keep their value), where it has more or fewer fields than the schema (``FIELDS``), or where its bytes are no text in
    ``encoding`` (``ENCODING``). Empty fields are null and no fault; empty lines are no rows. The text is parsed once; both tables
    come from the stored result, and every line is in one of them.
    """
    broken, texts = "_line", "_texts"
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    held = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    raw = (spark.read.schema(held).options(**options, header=header, enforceSchema=True, encoding=encoding).csv(path))
    names = [f.name for f in schema]
    # the faulty line once more as text fields, which tells a wrong value from a missing one
    as_text = ", ".join(f"`{n}` string" for n in [*names, broken])
    rows = raw.withColumn(texts, F.from_csv(broken, as_text, options))
    ragged = F.when(F.col(f"{texts}.{broken}").isNotNull(), F.lit(FIELDS))
    wrong = [F.when(F.col(f"{texts}.{broken}").isNull() & F.col(n).isNull() & F.col(f"{texts}.{n}").isNotNull(), F.lit(n))
             for n in names]
    strange = [F.coalesce(F.contains(F.col(f.name), F.lit("\ufffd")), F.lit(False)) for f in schema
               if isinstance(f.dataType, T.StringType)]
    encoded = [F.when(reduce(or_, strange), F.lit(ENCODING))] if strange else []
    line = F.coalesce(F.col(broken), F.when(reduce(or_, strange, F.lit(False)), F.to_csv(F.struct(*names), {"sep": sep})))
    checked = stage(rows.select(*names, line.alias(LINE), F.array_compact(F.array(ragged, *wrong, *encoded)).alias(REASONS)),
                    "checked")
    return checked.filter(F.col(LINE).isNull()).select(*names), checked.filter(F.col(LINE).isNotNull())


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Lines per reason; a line with several counts for each."""
    return (rejected.select(F.explode(REASONS).alias("MOTIVO")).groupBy("MOTIVO").agg(F.count(F.lit(1)).alias("N")))


def read_table(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """One sheet or table: parquet, or delimited text when the path says so. Names are normalised."""
    if path.rstrip("/").endswith((".csv", ".tsv", ".tab", ".txt")):
        return read_delimited(spark, path, schema, sep)
    df = normalise_names(spark.read.parquet(path))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("errorifexists").option("header", True).option("sep", sep).csv(path)


def publish_rates(sector: DataFrame, locality: DataFrame, path: str, **others: Ordered) -> int:
    """The rate tables as a version of the publication in ``path``, each ordered by its keys; the version's number.

    ``sector`` and ``locality`` carry CLASE_PREDIO, published as CLASE. ``others`` are published with them. Readers see all
    tables of one version; one that fails on the way leaves the version before.
    """
    named = {"sectores": sector.withColumnRenamed("CLASE_PREDIO", "CLASE"),
             "localidades": locality.withColumnRenamed("CLASE_PREDIO", "CLASE")}
    tables = {name: Ordered(df, ("CLASE", *[c for c in RATE_KEYS if c in df.columns])) for name, df in named.items()}
    return Publication(sector.sparkSession, path).write(tables | others)


def read_published(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the newest version published in ``path``, or of a given one, without its rank."""
    return Publication(spark, path).read(name, version).drop(RANK)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """One parquet folder per named table."""
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{path}/{name}")
