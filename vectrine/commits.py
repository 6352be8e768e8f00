"""Versioned state of a table or index: small JSON files on the cluster's file system.

Data folders are written first and never changed; the commit file that names
them appears last, whole, and never replaces another. A reader keeps the version
it opened.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession


_TURN = threading.Lock()


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


class Commits:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._folder = self._path(f"{self.root}/_commits")
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def version(self) -> int:
        """The newest version, -1 when nothing was committed yet."""
        if not self._fs.exists(self._folder):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(self._folder)]
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=-1)

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/_commits/{version:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, version: int, state: dict) -> None:
        """Publish a version whole or not at all; fails if it exists.

        The file is written under another name and renamed. HDFS refuses to
        rename onto a file; for file systems that do not, writers of one driver
        take turns.
        """
        target = self._path(f"{self.root}/_commits/{version:010d}.json")
        draft = self._path(f"{self.root}/_commits/{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        with _TURN:
            done = not self._fs.exists(target) and self._fs.rename(draft, target)
        if not done:
            self._fs.delete(draft, False)
            raise CommitConflict(f"version {version} of {self.root} exists")

    def folders(self, path: str) -> list[str]:
        """Names of the folders directly below ``path``."""
        folder = self._path(path)
        if not self._fs.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder) if s.isDirectory())

    def delete(self, name: str) -> None:
        """Remove a folder below the root."""
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def delete_all(self) -> None:
        self._fs.delete(self._path(self.root), True)

    def move_to(self, root: str) -> None:
        self._fs.mkdirs(self._path(root).getParent())
        if self._fs.exists(self._path(root)) or not self._fs.rename(self._path(self.root), self._path(root)):
            raise ValueError(f"cannot move {self.root} to {root}")
