"""Small files of a study through Hadoop's file systems: the same calls on a local folder and on any shared store."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


class Files:
    """Files below ``root``; a write goes to a temporary name first and is renamed, so no one reads half of it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.at(name))

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, sorted; none if it is missing."""
        if not self.exists(folder):
            return []
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self.at(folder)))

    def read(self, name: str) -> bytes:
        stream = self._fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write(self, name: str, data: bytes | str) -> None:
        data = data.encode() if isinstance(data, str) else data
        part, whole = self.at(name + ".part"), self.at(name)
        stream = self._fs.create(part, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        if self._fs.exists(whole):
            self._fs.delete(whole, False)
        if not self._fs.rename(part, whole):
            raise OSError(f"could not rename to {name}")

    def read_json(self, name: str, missing=None):
        return json.loads(self.read(name)) if self.exists(name) else missing

    def write_json(self, name: str, value) -> None:
        self.write(name, json.dumps(value, indent=2, ensure_ascii=False) + "\n")

    def modified(self, name: str) -> float:
        """Seconds since the epoch."""
        return self._fs.getFileStatus(self.at(name)).getModificationTime() / 1000

    def sha256(self, name: str) -> str | None:
        """Digest of a file, or of the names and digests of a folder's files; null if it is missing."""
        if not self.exists(name):
            return None
        if self._fs.getFileStatus(self.at(name)).isDirectory():
            inner = [f"{n} {self.sha256(f'{name}/{n}')}" for n in self.names(name) if not n.startswith((".", "_"))]
            return hashlib.sha256("\n".join(inner).encode()).hexdigest()
        return hashlib.sha256(self.read(name)).hexdigest()

    def move(self, name: str, to: str) -> None:
        target = self.at(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self.at(name), target):
            raise OSError(f"could not move {name} to {to}")

    def copy(self, name: str, to: str) -> None:
        """A file or a whole folder."""
        if self._fs.getFileStatus(self.at(name)).isDirectory():
            for n in self.names(name):
                self.copy(f"{name}/{n}", f"{to}/{n}")
        else:
            self.write(to, self.read(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)
