"""Publications: sets of tables that are replaced as a whole, with a proven order.

The tables of a version are written to a new folder each; then one numbered record names them. Readers follow the newest
record that is whole, so they see all tables of one version or all of another, whatever fails in between.

An ordered table has a rank column. Its files hold ranges of ranks, and the record lists the first and last rank of each;
``check_order`` proves from the files that they and the rows in them follow the keys.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators.control import numbered
from rentlens.sources.files import Files
from rentlens.sources.store import stage

RANK = "ORDEN"


@dataclass(frozen=True)
class Ordered:
    """A table that is written in the order of its keys; rows that tie come in the order of their other columns."""

    frame: DataFrame
    keys: tuple[str, ...]


def ranked(df: DataFrame, keys: list[str] | tuple[str, ...], name: str = RANK) -> DataFrame:
    """A total order as a column: 1, 2, 3... over all rows by the keys (nulls first), then all other columns. Rows that
    are equal in every column have different ranks. No partition holds more than its range."""
    others = [c for c in df.columns if c not in keys]
    return numbered(df, [], [*keys, *others], name)


def write_ordered(df: DataFrame, keys: list[str] | tuple[str, ...], path: str, rows_per_file: int = 1 << 20) -> None:
    """Write rows with their rank: files by ranges of ranks, rows in each file by rank."""
    rows = stage(ranked(df, keys), "ranked")
    files = max(1, -(-rows.count() // rows_per_file))
    whole = F.floor((F.col(RANK) - 1) / rows_per_file).cast("int")
    # the range of a row follows from its rank, so no sampling decides which file it is in
    (rows.withColumn("_file", whole).repartitionByRange(files, "_file").sortWithinPartitions(RANK).drop("_file")
     .write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(path))


def file_ranges(df: DataFrame) -> DataFrame:
    """(file, first, last, rows, straight) of a table with ranks: straight says that ranks go up by one from row to row."""
    meta = F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    rows = df.select(RANK, *meta)
    return rows.groupBy("file").agg(F.min(RANK).alias("first"), F.max(RANK).alias("last"), F.count(F.lit(1)).alias("rows"),
                                    (F.min(F.col(RANK) - F.col("row")) == F.max(F.col(RANK) - F.col("row"))).alias("straight"))


def check_order(df: DataFrame, keys: list[str] | tuple[str, ...]) -> None:
    """Prove the order of a table with ranks from its files; raises ValueError where it does not hold.

    Ranks must be 1 to n without a gap over files and go up by one in each, and no row's keys may be less than those of the
    row before. A file's rows are compared in windows of one file, and files by their first and last rows.
    """
    ranges = sorted(file_ranges(df).collect(), key=lambda r: r["first"])  # a row per file
    after = 1
    for r in ranges:
        if not (r["straight"] and r["first"] == after and r["last"] - r["first"] + 1 == r["rows"]):
            raise ValueError(f"{r['file']} does not hold ranks {after} and on in order")
        after = r["last"] + 1
    keyed = df.select(RANK, F.struct(*keys).alias("key"), F.col("_metadata.file_name").alias("file"))
    inside = Window.partitionBy("file").orderBy(RANK)
    wrong = keyed.withColumn("before", F.lag("key").over(inside)).filter("before > key").limit(1).collect()
    ends = keyed.groupBy("file").agg(F.min_by("key", RANK).alias("head"), F.max_by("key", RANK).alias("tail"),
                                     F.min(RANK).alias("first"))
    borders = ends.withColumn("before", F.lag("tail").over(Window.orderBy("first")))  # a row per file
    wrong += borders.filter("before > head").limit(1).collect()
    if wrong:
        raise ValueError(f"rows are not in the order of {', '.join(keys)}: {wrong[0]}")


class Publication:
    """Versions of a set of tables below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.files = spark, Files(spark, path)

    def write(self, tables: dict[str, DataFrame | Ordered], note: str = "") -> int:
        """Write all tables and then the record that names them; the number of the version. A failure before the record
        leaves the version before as it was."""
        folder, body = f"data/{uuid.uuid4().hex}", {}
        for name, table in tables.items():
            keys = list(table.keys) if isinstance(table, Ordered) else []
            path = f"{folder}/{name}"
            if keys:
                write_ordered(table.frame, keys, self.files.full(path))
            else:
                table.write.mode("errorifexists").parquet(self.files.full(path))
            df = table.frame if keys else table
            schema = df.schema.add(RANK, "long") if keys else df.schema
            there = self.files.listing(path)
            body[name] = {"folder": path, "schema": schema.jsonValue(), "keys": keys,
                          "files": {n: s for n, (s, _) in there.items()}}
            if keys:
                found = file_ranges(self._frame(body[name])).collect()  # a row per file
                body[name]["ranges"] = {r["file"]: [r["first"], r["last"]] for r in found}
        return self.files.append("_log", {"tables": body, "note": note})

    def versions(self) -> list[int]:
        return [n for n in self.files.numbers("_log") if self.files.numbered("_log", n)]

    def manifest(self, version: int | None = None) -> dict:
        found = self.files.newest("_log") if version is None else (version, self.files.numbered("_log", version))
        if not found or not found[1]:
            raise KeyError(f"nothing is published in {self.files.root}" + (f" as {version}" if version else ""))
        return found[1]["tables"]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the newest version, or of a given one."""
        return self._frame(self.manifest(version)[name])

    def check(self, version: int | None = None) -> None:
        """Files as the record lists them, and the order of every ordered table."""
        for name, entry in self.manifest(version).items():
            there = self.files.listing(entry["folder"])
            if {n: s for n, (s, _) in there.items()} != entry["files"]:
                raise ValueError(f"the files of {name} are not those that were published")
            if entry["keys"]:
                check_order(self._frame(entry), entry["keys"])

    def prune(self, keep: int = 2) -> None:
        """Remove the data of all but the last ``keep`` versions, and what failed writes have left. Not while one runs."""
        versions = self.versions()
        for old in versions[:-keep]:
            self.files.delete(f"_log/{old:020d}.json")
        used = {e["folder"].split("/")[1] for v in versions[-keep:] for e in self.manifest(v).values()}
        for folder in self.files.names("data"):
            if folder not in used:
                self.files.delete(f"data/{folder}")

    def _frame(self, entry: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(self.files.full(entry["folder"]))


def union_of(publication: Publication, names: list[str], label: str) -> DataFrame:
    """Tables of the newest version as one, told apart by ``label``."""
    tables = publication.manifest()
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [publication._frame(tables[n]).withColumn(label, F.lit(n)) for n in names])
