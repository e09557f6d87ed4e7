"""Folders that are replaced as a whole: versions below the folder and a pointer to the current one.

``<folder>/.versions/<number>-<id>`` holds the files of one write, ``<folder>/CURRENT`` names
the version that readers see.  The pointer is the last thing a write changes, by one rename
over the old pointer, so a job that fails, or whose driver is lost, at any moment before
leaves the old version in place, and a reader sees either the old or the new rows, never a
mixture.  The version before the current one is kept for readers that are still at it;
older ones, and remains of failed writes older than a day, go with the next write.

Everything goes through the file system that the folder's path names, so the folder may lie
on any shared store.  Writers of one folder must not run at the same time (the one that
publishes last would win).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER, VERSIONS = "CURRENT", ".versions"
STALE_SECONDS = 24 * 3600


class Files:
    """A few file operations of the store that ``path`` lies on."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self.path(path).getFileSystem(self._conf)

    def path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self._fs.exists(self.path(p))

    def delete(self, p: str) -> None:
        self._fs.delete(self.path(p), True)

    def names(self, p: str) -> dict[str, float]:
        """Name and modification time (seconds) of what lies in folder ``p``."""
        if not self.exists(p):
            return {}
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in self._fs.listStatus(self.path(p))}

    def read(self, p: str) -> str | None:
        if not self.exists(p):
            return None
        stream = self._fs.open(self.path(p))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, p: str, text: str) -> None:
        """Write ``text`` to a new file and rename it over ``p`` in one step."""
        new = f"{p}.{uuid.uuid4().hex[:12]}.tmp"
        stream = self._fs.create(self.path(new), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        target = self._fs.makeQualified(self.path(p))
        options = self._jvm.java.lang.reflect.Array.newInstance(fs.Options.Rename.OVERWRITE.getClass(), 1)
        options[0] = fs.Options.Rename.OVERWRITE
        fs.FileContext.getFileContext(target.toUri(), self._conf).rename(self._fs.makeQualified(self.path(new)), target, options)


def current(spark: SparkSession, folder: str) -> str | None:
    """Folder of the version that ``folder`` points to; None if nothing was published there."""
    name = Files(spark, folder).read(f"{folder.rstrip('/')}/{POINTER}")
    return f"{folder.rstrip('/')}/{VERSIONS}/{name.strip()}" if name else None


def publish(spark: SparkSession, folder: str, write: Callable[[str], None], keep: int = 1) -> str:
    """Run ``write(new version folder)``, then make it the current version of ``folder``.

    If ``write`` fails, its files are removed and the current version stays.  ``keep`` older
    versions are kept besides the new one.
    """
    folder = folder.rstrip("/")
    files = Files(spark, folder)
    before = (files.read(f"{folder}/{POINTER}") or "").strip()
    number = int(before.split("-")[0]) + 1 if before else 1
    name = f"{number:09d}-{uuid.uuid4().hex[:12]}"
    target = f"{folder}/{VERSIONS}/{name}"
    try:
        write(target)
        files.replace(f"{folder}/{POINTER}", name)
    except BaseException:
        files.delete(target)
        raise
    for old, changed in files.names(f"{folder}/{VERSIONS}").items():
        if not old.split("-")[0].isdigit():
            continue                                       # not a version
        finished = files.exists(f"{folder}/{VERSIONS}/{old}/_SUCCESS")
        if int(old.split("-")[0]) < number - keep or (old not in (name, before) and (finished or changed < time.time() - STALE_SECONDS)):
            files.delete(f"{folder}/{VERSIONS}/{old}")
    return target
