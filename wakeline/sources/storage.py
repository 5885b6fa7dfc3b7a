"""Small things done to files by the driver: list, read, create once, delete. On any file system Spark reaches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Found:
    """A file below a folder: its path relative to that folder, and its size."""

    name: str
    size: int


class Storage:
    """One folder and what lies below it; all names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.fs.makeQualified(path).toString()
        self._new_path = spark._jvm.org.apache.hadoop.fs.Path
        self._to_text = spark._jvm.org.apache.commons.io.IOUtils.toString

    def at(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def _path(self, name: str):
        return self._new_path(self.at(name))

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def folders(self, name: str = "") -> list[str]:
        """Names of the direct child folders."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(name)) if s.isDirectory())

    def files(self, name: str = "") -> list[Found]:
        """Every file below, leaving out what starts with ``_`` or ``.`` on the way."""
        out = []
        if self.exists(name):
            listed = self.fs.listFiles(self._path(name), True)
            while listed.hasNext():
                status = listed.next()
                below = status.getPath().toString()[len(self.at(name)) + 1:]
                if not any(part[0] in "_." for part in below.split("/")):
                    out.append(Found(f"{name}/{below}" if name else below, status.getLen()))
        return sorted(out, key=lambda f: f.name)

    def create(self, name: str, text: str) -> None:
        """Write a file that must not exist yet: of two writers one fails."""
        stream = self.fs.create(self._path(name), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self._to_text(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
