"""Small files in any file system that Spark reaches, by the Hadoop API of the driver.

A record is a file that is made once, under a number, and holds the digest of its own text. A reader takes the record with
the highest number whose digest is right, so a half-written one is as good as none, and two writers cannot both have
made the same number.
"""

from __future__ import annotations

import hashlib
import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The files below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        context = spark.sparkContext
        self._jvm, self._conf = context._jvm, context._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def full(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(self.full(name)))

    def names(self, name: str = "") -> list[str]:
        """Names of what lies directly in a folder; none where there is no folder."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.full(name))))

    def listing(self, name: str) -> dict[str, list[int]]:
        """Length and time of change of every data file below a folder, by its path there."""
        out, base = {}, self._fs.makeQualified(self._path(self.full(name))).toUri().getPath().rstrip("/") + "/"
        found = self._fs.listFiles(self._path(self.full(name)), True)
        while found.hasNext():
            status = found.next()
            path = status.getPath().toUri().getPath()
            if not status.getPath().getName().startswith(("_", ".")):
                out[path.removeprefix(base)] = [status.getLen(), status.getModificationTime()]
        return dict(sorted(out.items()))

    def read(self, name: str) -> bytes | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._path(self.full(name)))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, name: str, data: bytes) -> bool:
        """Make a file; False where it is there already, which leaves it as it is."""
        try:
            stream = self._fs.create(self._path(self.full(name)), False)
        except Py4JJavaError:
            if self.exists(name):
                return False
            raise
        stream.write(data)
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(self.full(name)), True)

    # ---- records ---------------------------------------------------------------------------------------

    def put_record(self, name: str, body: dict) -> bool:
        text = json.dumps(body, sort_keys=True)
        sealed = {"sha256": hashlib.sha256(text.encode()).hexdigest(), "body": body}
        return self.create(name, json.dumps(sealed, sort_keys=True, indent=1).encode())

    def record(self, name: str) -> dict | None:
        """The body of a record; None where it is missing, torn or changed."""
        data = self.read(name)
        try:
            sealed = json.loads(data or b"")
            text = json.dumps(sealed["body"], sort_keys=True)
            return sealed["body"] if hashlib.sha256(text.encode()).hexdigest() == sealed["sha256"] else None
        except (ValueError, KeyError, TypeError):
            return None

    def numbers(self, folder: str) -> list[int]:
        """Numbers of all records of a folder, torn ones too."""
        return sorted(int(n.removesuffix(".json")) for n in self.names(folder) if n.removesuffix(".json").isdigit())

    def numbered(self, folder: str, number: int) -> dict | None:
        return self.record(f"{folder}/{number:020d}.json")

    def newest(self, folder: str) -> tuple[int, dict] | None:
        for number in reversed(self.numbers(folder)):
            body = self.numbered(folder, number)
            if body is not None:
                return number, body
        return None

    def append(self, folder: str, body: dict) -> int:
        """Make the record after the last one; a number that another writer has taken is left to it."""
        while True:
            number = max(self.numbers(folder), default=0) + 1
            if self.put_record(f"{folder}/{number:020d}.json", body):
                return number
