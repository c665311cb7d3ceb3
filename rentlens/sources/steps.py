"""Named steps that any session finds again, keyed by what they were made of.

The key of a step is the digest of its code (the function, and all functions and constants of this package that it
reaches), its parameters, and its inputs: for a step its key, for a source its plan and the listing of its files. A step
whose key is known is read, without a job; one whose code or inputs have changed is made anew, and so are those after it.

A step's files are written to a folder of their own, and its manifest (files with lengths, schema, inputs) last.
Without a manifest, or with files that do not agree with it, there is no step.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import json
import types
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rentlens.sources.files import Files

PACKAGE = __name__.split(".")[0]
_PLAIN = (int, float, complex, str, bytes, bool, type(None))


def _digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=repr).encode()).hexdigest()


def _plain(value: object) -> str | None:
    """The text of a constant, the same in every session; None where it is none."""
    if isinstance(value, _PLAIN):
        return repr(value)
    if isinstance(value, (list, tuple)):
        parts = [_plain(v) for v in value]
    elif isinstance(value, (set, frozenset)):
        parts = [_plain(v) for v in value]
        parts = None if None in parts else sorted(parts)
    elif isinstance(value, dict):
        parts = [_plain([k, v]) for k, v in value.items()]
    else:
        return None
    return None if parts is None or None in parts else f"{type(value).__name__}({','.join(parts)})"


def code_digest(*functions: Callable, package: str = PACKAGE) -> str:
    """Digest of functions and of everything of ``package`` that they reach by name: functions, classes, constants.

    Two functions that differ in a constant, a default, a helper's helper or a closed-over value differ in it. A closed-over
    table is refused, as it would be an input that nobody sees.
    """
    seen: set[tuple[str, str]] = set()
    parts: list[str] = []

    def follow(value: object, names: tuple[str, ...]) -> None:
        if isinstance(value, types.ModuleType):
            if value.__name__.split(".")[0] == package:
                for name in names:
                    if hasattr(value, name):
                        follow(getattr(value, name), ())
        elif isinstance(value, (types.FunctionType, types.MethodType, functools.partial)) or inspect.isclass(value):
            visit(value)
        elif (text := _plain(value)) is not None:
            parts.append(text)

    def code(block: types.CodeType, scope: dict) -> None:
        parts.append(block.co_code.hex())
        parts.append(repr(block.co_names))
        for constant in block.co_consts:
            if isinstance(constant, types.CodeType):
                code(constant, scope)
            else:
                parts.append(_plain(constant) or repr(constant))
        for name in block.co_names:
            if name in scope:
                follow(scope[name], block.co_names)

    def visit(value: object) -> None:
        if isinstance(value, functools.partial):
            for bound in (*value.args, *value.keywords.values()):
                closed(bound)
            parts.append(repr(sorted(value.keywords)))
            return visit(value.func)
        value = inspect.unwrap(value) if callable(value) else value
        value = getattr(value, "__func__", value)
        where = (getattr(value, "__module__", None) or "", getattr(value, "__qualname__", ""))
        if where[0].split(".")[0] != package and value not in functions:
            return None  # libraries are not ours to follow
        if where in seen and value not in functions:
            return None
        seen.add(where)
        parts.append(repr(where[1]))
        if inspect.isclass(value):
            for name, member in sorted(vars(value).items()):
                member = getattr(member, "fget", None) or getattr(member, "func", None) or getattr(member, "__func__", member)
                if isinstance(member, types.FunctionType):
                    visit(member)
            return None
        if isinstance(value, types.FunctionType):
            parts.append(_plain(value.__defaults__) or "")
            parts.append(_plain(value.__kwdefaults__) or "")
            code(value.__code__, value.__globals__)
            for cell in value.__closure__ or ():
                closed(cell.cell_contents)
        return None

    def closed(value: object) -> None:
        if isinstance(value, DataFrame):
            raise ValueError("a step's function holds a table: give it as an input")
        if (text := _plain(value)) is not None:
            parts.append(text)
        elif callable(value):
            visit(value)
        else:
            raise ValueError(f"a step's function holds a {type(value).__name__}, which has no digest")

    for function in functions:
        visit(function)
    return _digest(parts)


def frame_digest(df: DataFrame) -> str:
    """Digest of a table that is read from files: its plan, and the path, length and time of change of each file.

    Tables with other sources, such as rows made in the session, are refused: another session could not tell them apart.
    """
    spark, plan = df.sparkSession, df._jdf.queryExecution().optimizedPlan()  # with named subqueries put in their places
    leaves = plan.collectLeaves()
    kinds = {leaves.apply(i).getClass().getSimpleName() for i in range(leaves.size())}
    if kinds != {"LogicalRelation"}:
        raise ValueError(f"a source must be read from files, not from {', '.join(sorted(kinds))}")
    setting, before = "spark.sql.debug.maxToStringFields", spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set(setting, str(2 ** 31 - 1))  # a shortened plan would hide what differs
    try:
        text = plan.canonicalized().toString()
    finally:
        spark.conf.set(setting, before)
    files = []
    for path in sorted(df.inputFiles()):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place)
        files.append([path, status.getLen(), status.getModificationTime()])
    return _digest(text, files, df.schema.jsonValue())


@dataclass(frozen=True)
class Table:
    """A table and the digest of what it was made of."""

    frame: DataFrame
    key: str


class Steps:
    """A catalogue of steps in one folder, which sessions share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)
        self.made: list[str] = []  # what this object had to compute

    def source(self, df: DataFrame) -> Table:
        return Table(df, frame_digest(df))

    def run(self, name: str, make: Callable[..., DataFrame], *inputs: Table, code: tuple[Callable, ...] = (),
            **parameters) -> Table:
        """The step ``name``: ``make`` of the inputs' frames and the parameters, or what an equal step has stored.

        ``code`` names the functions that make the step where ``make`` is only a way to call them.
        """
        key = _digest(name, code_digest(*(code or (make,))), _plain(parameters) or repr(sorted(parameters.items())),
                      [t.key for t in inputs])
        manifest = self._manifest(name, key)
        if manifest is None:
            manifest = self._write(name, key, make(*[t.frame for t in inputs], **parameters), [t.key for t in inputs])
        newest = self.files.newest(f"{name}/_log")
        if newest is None or newest[1]["key"] != key:
            self.files.append(f"{name}/_log", {"key": key})
        return Table(self._frame(name, key, manifest), key)

    def load(self, name: str) -> DataFrame:
        """The step that was last run under a name, in this or another session."""
        newest = self.files.newest(f"{name}/_log")
        manifest = newest and self._manifest(name, newest[1]["key"])
        if not manifest:
            raise KeyError(f"no step {name} in {self.files.root}")
        return self._frame(name, newest[1]["key"], manifest)

    def names(self) -> list[str]:
        return [n for n in self.files.names() if self.files.newest(f"{n}/_log")]

    def keys(self, name: str) -> list[str]:
        """Keys under a name, in the order in which they were run."""
        found = (self.files.numbered(f"{name}/_log", n) for n in self.files.numbers(f"{name}/_log"))
        return [r["key"] for r in found if r]

    def prune(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` different tables of each name, and what a torn write has left."""
        for name in self.names():
            kept = list(dict.fromkeys(reversed(self.keys(name))))[:keep]
            for key in self.files.names(name):
                if key != "_log" and key not in kept:
                    self.files.delete(f"{name}/{key}")
            for key in kept:
                manifest = self._manifest(name, key)
                for part in self.files.names(f"{name}/{key}"):
                    if manifest and part not in ("manifest.json", manifest["folder"]):
                        self.files.delete(f"{name}/{key}/{part}")

    def _manifest(self, name: str, key: str) -> dict | None:
        """The manifest of a step, if its files are all there with their lengths."""
        manifest = self.files.record(f"{name}/{key}/manifest.json")
        if manifest is None or not self.files.exists(f"{name}/{key}/{manifest['folder']}"):
            return None
        there = self.files.listing(f"{name}/{key}/{manifest['folder']}")
        return manifest if {n: s for n, (s, _) in there.items()} == manifest["files"] else None

    def _write(self, name: str, key: str, df: DataFrame, inputs: list[str]) -> dict:
        folder = f"rows-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(self.files.full(f"{name}/{key}/{folder}"))
        self.made.append(name)
        there = self.files.listing(f"{name}/{key}/{folder}")
        manifest = {"folder": folder, "files": {n: s for n, (s, _) in there.items()}, "schema": df.schema.jsonValue(),
                    "inputs": inputs}
        while not self.files.put_record(f"{name}/{key}/manifest.json", manifest):
            other = self._manifest(name, key)
            if other is not None:  # another session was first; an equal step has equal rows
                self.files.delete(f"{name}/{key}/{folder}")
                return other
            self.files.delete(f"{name}/{key}/manifest.json")
        return manifest

    def _frame(self, name: str, key: str, manifest: dict) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(self.files.full(f"{name}/{key}/{manifest['folder']}"))
