"""Replacing a table without a moment in which a failure loses it, and a lock for what must be one step."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Folder:
    """A path in whatever file system Spark reads it from."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        at = self._at(self.path)
        self._files = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self._beside = f"{self.path.rpartition('/')[0]}/_{at.getName()}"  # readers of the folder above leave out such names

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def beside(self, what: str) -> str:
        return f"{self._beside}-{what}"

    def exists(self, path: str) -> bool:
        return self._files.exists(self._at(path))

    def delete(self, path: str) -> None:
        self._files.delete(self._at(path), True)

    def rename(self, path: str, to: str) -> None:
        self._files.mkdirs(self._at(to).getParent())
        if not self._files.rename(self._at(path), self._at(to)):
            raise OSError(f"{path} can't be renamed to {to}")

    def claim(self, path: str) -> bool:
        """Whether this call made the file."""
        try:
            return self._files.createNewFile(self._at(path))
        except Py4JJavaError as failure:
            if "FileAlreadyExists" in failure.java_exception.getClass().getName():  # made by another in this moment
                return False
            raise

    def age(self, path: str) -> float:
        """Seconds since the file was made; 0 if it is gone."""
        try:
            return time.time() - self._files.getFileStatus(self._at(path)).getModificationTime() / 1000
        except Py4JJavaError:
            if self.exists(path):
                raise
            return 0.0


def written_beside(df: DataFrame, folder: Folder, partition_by: list[str] | None = None, kind: str = "parquet") -> str:
    """The rows in a new folder beside the table; nothing is left if that fails."""
    new = folder.beside(f"new-{uuid.uuid4().hex}")
    try:
        writer = df.write.format(kind)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(new)
    except BaseException:
        folder.delete(new)
        raise
    return new


def swap_in(folder: Folder, new: str) -> None:
    """Put the new folder in the table's place. Between the two renames the old rows are beside it, where ``recovered`` finds them.

    On stores whose rename copies, that moment is as long as the copy.
    """
    old = folder.beside("old")
    if folder.exists(folder.path):
        folder.delete(old)
        folder.rename(folder.path, old)
    folder.rename(new, folder.path)
    folder.delete(old)


def recovered(spark: SparkSession, path: str) -> str:
    """The path, with the old rows put back if a swap ended between its renames."""
    folder = Folder(spark, path)
    if not folder.exists(path) and folder.exists(folder.beside("old")):
        folder.rename(folder.beside("old"), path)
    return path


@contextmanager
def locked(spark: SparkSession, path: str, wait_seconds: float = 300, stale_seconds: float = 3600) -> Iterator[None]:
    """One holder at a time, among all who use this on the path. A lock older than ``stale_seconds`` is that of a lost job."""
    folder = Folder(spark, path)
    lock, until = folder.beside("lock"), time.time() + wait_seconds
    while not folder.claim(lock):
        if folder.age(lock) > stale_seconds:
            folder.delete(lock)
        elif time.time() > until:
            raise TimeoutError(f"{lock} is held")
        else:
            time.sleep(0.2)
    try:
        yield
    finally:
        folder.delete(lock)
