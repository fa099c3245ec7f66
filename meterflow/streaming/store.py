"""Names, small texts and removal in the file system of a folder, as the session's Hadoop configuration reaches it."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if it is missing."""
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """A new file that appears whole or not at all: written aside and renamed; one that exists is an error."""
        aside = self._path(f"{name}.aside")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(self._path(name)) or not self._fs.rename(aside, self._path(name)):
            raise FileExistsError(name)

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
