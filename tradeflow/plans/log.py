"""A log of what counts: small numbered files, each written whole or not at all.

An entry says which folders make up the tables of a store from now on. Folders are written first and
never changed; the entry is written last, so a job that dies leaves folders that no entry names, and
readers see the state of the last entry throughout. An entry is put in place by a rename that does not
overwrite: of two writers that started from one state the second fails and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConflictError(RuntimeError):
    """Another writer has committed since this one read the state."""


class Log:
    """Numbered JSON entries in a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self.folder = self._path(folder)
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self.folder.getFileSystem(self._conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.makeQualified(self.folder).toUri(), self._conf
        )

    def _path(self, *parts: Any):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def numbers(self) -> list[int]:
        """Numbers of the entries, in order."""
        if not self._files.exists(self.folder):
            return []
        names = [str(f.getPath().getName()) for f in self._files.listStatus(self.folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def entry(self, number: int) -> dict:
        stream = self._files.open(self._path(self.folder, f"{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> tuple[int, dict]:
        """Number and content of the last entry; 0 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.entry(numbers[-1])) if numbers else (0, {})

    def commit(self, number: int, content: dict) -> None:
        """Write the entry; ConflictError if there is one of that number or a later one."""
        if any(n >= number for n in self.numbers()):
            raise ConflictError(f"entry {number} of {self.folder} exists")
        self._files.mkdirs(self.folder)
        draft = self._path(self.folder, f".{uuid.uuid4().hex}.draft")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        options = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        never_overwrite = self._gateway.new_array(options, 1)
        never_overwrite[0] = options.NONE
        try:
            self._context.rename(draft, self._path(self.folder, f"{number:010d}.json"), never_overwrite)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if "AlreadyExists" in str(error.java_exception):
                raise ConflictError(f"entry {number} of {self.folder} exists") from error
            raise

    def forget(self, before: int) -> None:
        """Remove the entries before a number."""
        for n in self.numbers():
            if n < before:
                self._files.delete(self._path(self.folder, f"{n:010d}.json"), False)

    def folders(self, path: str) -> list[str]:
        """Names of the folders under a path."""
        where = self._path(path)
        if not self._files.exists(where):
            return []
        return sorted(f.getPath().getName() for f in self._files.listStatus(where) if f.isDirectory())

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)
