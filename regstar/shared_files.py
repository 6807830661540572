"""Small files in the cluster's store (whatever scheme a path has), through the
Hadoop file system that the session itself reads and writes with."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    """Files below ``root``. Nothing below it is ever changed in place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.root).getFileSystem(self._conf)

    def path(self, *names: str) -> str:
        return posixpath.join(self.root, *names)

    def _at(self, *names: str):
        return self._hadoop.Path(self.path(*names))

    def create(self, text: str, *names: str) -> bool:
        """Write a file that must not exist yet, whole or not at all; False
        where another writer was first. The text is written under another name
        and renamed, which (on HDFS) is atomic and fails if the name is taken."""
        draft = self._at(*names[:-1], f".{names[-1]}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        context = self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf)
        try:
            context.rename(draft, self._at(*names), options)
        except Exception as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def read(self, *names: str) -> str | None:
        """A file's text; None where there is none."""
        at = self._at(*names)
        if not self._fs.exists(at):
            return None
        source = self._fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def names(self, *names: str) -> dict[str, float]:
        """Names in a folder, with the time (seconds) each was last changed."""
        at = self._at(*names)
        if not self._fs.exists(at):
            return {}
        found = self._fs.listStatus(at)
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in found}

    def remove(self, *names: str) -> None:
        self._fs.delete(self._at(*names), True)
