"""Small files of a folder on any file system that Spark can reach: names, texts, atomic publishing."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """Names and small texts under ``path``; data files are read and written by Spark itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Names directly below a folder, sorted; none if there is no such folder."""
        at = self._at(name)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Writes a text so that readers see all of it or nothing; the name must be new."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.draft")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
