"""The few Hadoop file-system calls the library needs, for any URI Spark can open."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    length: int


class AlreadyExists(Exception):
    """A file that must be created new is there already."""


class Storage:
    """Listing, reading and create-once writing of small files."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_dir(self, path: str) -> bool:
        return self.exists(path) and self._fs(path).getFileStatus(self._path(path)).isDirectory()

    def list(self, path: str) -> list[Entry]:
        """Direct children in name order."""
        found = [
            Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen())
            for s in self._fs(path).listStatus(self._path(path))
        ]
        return sorted(found, key=lambda e: e.name)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Write a file in one step; raise ``AlreadyExists`` if somebody was first."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(path).toUri(), self._conf
        )
        draft = self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = self._fs(path).create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        no_overwrite = self._spark.sparkContext._gateway.new_array(kinds, 0)
        try:
            context.rename(draft, self._path(path), no_overwrite)
        except Exception as err:
            self._fs(path).delete(draft, False)
            if "FileAlreadyExistsException" in str(err):
                raise AlreadyExists(path) from err
            raise

    def size(self, path: str) -> int:
        """Bytes of all files below a directory."""
        return self._fs(path).getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        """Remove a file, or a directory with all it holds."""
        self._fs(path).delete(self._path(path), True)

    def make_temporary(self, path: str) -> None:
        """Create a directory that goes when the session's JVM exits."""
        self._fs(path).mkdirs(self._path(path))
        self._fs(path).deleteOnExit(self._path(path))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path for new data under the session's checkpoint directory, removed at exit.

    Only a local session may do without ``spark.checkpoint.dir``; on a cluster
    a machine-local folder would not be shared by the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    parent = f"{root.rstrip('/')}/rowtide-{uuid.uuid4().hex}"
    Storage(spark).make_temporary(parent)
    return f"{parent}/{label}"


def connect(spark: SparkSession, options: dict[str, str | None]) -> None:
    """Pass object-store options to Hadoop; empty ones are left out."""
    conf = spark._jsc.hadoopConfiguration()
    for key, option in options.items():
        if option not in (None, ""):
            conf.set(key, str(option))
