"""The folder that driver and executors share, and a store of immutable objects on any file system that Spark reads."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

_own_folder: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is missing and the master is local (tests), a folder of this process's own is made and
    removed at exit. On a cluster a missing setting is an error, since a machine-local folder would lose data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="quillsieve-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return f"file://{_own_folder[0]}"


class PublishError(Exception):
    """An object that exists already with other bytes or is not there, or a run that is incomplete."""


@dataclass(frozen=True)
class Meta:
    """An object's key, size in bytes and SHA-256."""

    key: str
    size_bytes: int
    sha256: str


class Store:
    """Objects by key below a root of any file system that Spark reads. An object never changes once it is there."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, key: str):
        if ".." in key.split("/"):
            raise ValueError(f"{key!r} leaves the store")
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}".rstrip("/"))

    def url(self, key: str) -> str:
        return self._path(key).toString()

    def put(self, key: str, data: bytes) -> Meta:
        """Writes an object once: the same bytes again are no change, others are refused.

        The bytes go to a name of their own first and are renamed, so no reader sees a part; of two writers at once one
        finds the other's object and compares.
        """
        if not self.exists(key):
            part = f"{key}.part-{uuid.uuid4().hex}"
            out = self._fs.create(self._path(part), False)
            try:
                out.write(data)
            finally:
                out.close()
            if self.exists(key) or not self._fs.rename(self._path(part), self._path(key)):
                self._fs.delete(self._path(part), False)
        if hashlib.sha256(self.get(key)).digest() != hashlib.sha256(data).digest():
            raise PublishError(f"{key} exists with other bytes")
        return Meta(key, len(data), hashlib.sha256(data).hexdigest())

    def get(self, key: str) -> bytes:
        if not self.exists(key):
            raise PublishError(f"{key} does not exist")
        stream = self._fs.open(self._path(key))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._path(key)) and self._fs.getFileStatus(self._path(key)).isFile()

    def head(self, key: str) -> Meta | None:
        if not self.exists(key):
            return None
        data = self.get(key)
        return Meta(key, len(data), hashlib.sha256(data).hexdigest())

    def list(self, prefix: str) -> list[str]:
        """Every key that starts with ``prefix``, in order, without parts of objects that are being written."""
        folder = prefix.rpartition("/")[0]
        if not self._fs.exists(self._path(folder)):
            return []
        root, out = self._fs.resolvePath(self._path("")).toUri().getPath().rstrip("/"), []
        found = self._fs.listFiles(self._path(folder), True)
        while found.hasNext():
            path = self._fs.resolvePath(found.next().getPath()).toUri().getPath()
            out.append(path[len(root) + 1 :])
        return sorted(k for k in out if k.startswith(prefix) and ".part-" not in k and not k.endswith(".crc"))

    def delete(self, key: str) -> None:
        """Removes an object or a folder of a table version; only ``files.reload`` does so, for versions that no one names."""
        self._fs.delete(self._path(key), True)
