"""Small files of a store, through Hadoop's file systems."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SmallFiles:
    """Files of one folder that are written once and never changed.

    ``write_once`` shows a file only when it is complete, under a name nobody
    else has: the content is written aside and then given its name, by a hard link
    on a mounted file system, by a rename that refuses an existing target elsewhere.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = folder
        self._path = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._system = self._path.getFileSystem(self._conf)
        self.mounted = self._system.getUri().getScheme() == "file"

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def names(self) -> list[str]:
        if not self._system.exists(self._path):
            return []
        return [s.getPath().getName() for s in self._system.listStatus(self._path) if not s.getPath().getName().startswith(".")]

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> bool:
        """Whether the file is ours; false if there is one of that name."""
        aside, target = self._at(f".{name}-{uuid.uuid4().hex}"), self._at(name)
        stream = self._system.create(aside, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            return self._link(aside, target) if self.mounted else self._rename(aside, target)
        finally:
            self._system.delete(aside, False)

    def _link(self, aside, target) -> bool:
        try:
            os.link(aside.toUri().getPath(), target.toUri().getPath())
            return True
        except FileExistsError:
            return False

    def _rename(self, aside, target) -> bool:
        fs = self._jvm.org.apache.hadoop.fs
        options = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            fs.FileContext.getFileContext(self._system.getUri(), self._conf).rename(
                self._system.makeQualified(aside), self._system.makeQualified(target), options
            )
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
