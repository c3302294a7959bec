"""A log of committed versions: what a table's readers may see.

Writing is in two phases.  First the data goes to folders of its own, which no
reader looks for; then one small JSON file that names them appears under
``<path>/_commits`` by a rename.  Readers take the folders from the newest
commit, so they see a version whole or not at all, whenever a writer dies.  The
first commit of an id stands: a batch that runs again finds it and leaves the
data alone.  File access is by the file system of the path, as Spark's own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._folder = self._at(f"{self.path}/_commits")
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _file(self, version: int):
        return self._at(f"{self.path}/_commits/{int(version):020d}.json")

    def versions(self) -> list[int]:
        """Committed ids, ascending."""
        if not self._fs.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int) -> dict | None:
        """What was committed under an id; None if nothing was."""
        file = self._file(version)
        if not self._fs.exists(file):
            return None
        stream = self._fs.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self, before: int | None = None) -> dict | None:
        """The newest commit (of those below ``before``), None if there is none."""
        known = [v for v in self.versions() if before is None or v < before]
        return self.read(known[-1]) if known else None

    def commit(self, version: int, entry: dict) -> bool:
        """Makes ``entry`` visible under an id of at least 0; False, and no change, if the id was committed before."""
        if version < 0:
            raise ValueError("a version is 0 or more")
        if self._fs.exists(self._file(version)):
            return False
        self._fs.mkdirs(self._folder)
        draft = self._at(f"{self.path}/_commits/.{version}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(entry | {"version": int(version)}).encode()))
        finally:
            out.close()
        if self._fs.rename(draft, self._file(version)):
            return True
        if self._fs.exists(self._file(version)):  # another writer was first
            return False
        raise OSError(f"version {version} of {self.path} could not be committed")
