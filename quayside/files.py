"""Folders in whatever file system Spark reaches them through, and folders that take the place of others."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from typing import NamedTuple, Protocol

from pyspark.sql import SparkSession


class Child(NamedTuple):
    name: str
    folder: bool
    age: float  # seconds since it was changed


class Folder:
    """A folder, and the file system it lies in."""

    #: Seconds to wait for another writer to publish, and after which its lock counts as left behind.
    WAIT, STALE = 120, 600

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._at = self._path(path)
        self._system = self._at.getFileSystem(spark._jsc.hadoopConfiguration())
        self._spark = spark
        self.scheme = self._system.getScheme()
        self.path = self._at.toString()

    def child(self, name: str) -> str:
        return self._path(self._at, name).toString()

    def beside(self, label: str) -> str:
        """A hidden sibling, which a reader of the parent folder passes over."""
        name = f"_{self._at.getName()}.{label}"
        parent = self._at.getParent()
        return self._path(parent, name).toString() if parent else name

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def create(self) -> None:
        self._system.mkdirs(self._at)

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        """Move a folder. Hadoop would put it into one that is there already, so that is an error."""
        if self.exists(new) or not self._system.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} cannot be renamed to {new}")

    def children(self) -> list[Child]:
        if not self.exists(self.path):
            return []
        now = time.time()
        return [Child(s.getPath().getName(), s.isDirectory(), now - s.getModificationTime() / 1000) for s in self._system.listStatus(self._at)]

    def read(self, path: str) -> str | None:
        """The content of a small file, if it is there."""
        return self._spark.read.text(path, wholetext=True).first()["value"] if self.exists(path) else None

    def write(self, path: str, text: str) -> None:
        out = self._system.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    @contextmanager
    def locked(self) -> Iterator[None]:
        """Only one writer publishes to the folder at a time: a lock file beside it, made new or waited for."""
        lock = self.beside("lock")
        until = time.monotonic() + self.WAIT
        while not self._system.createNewFile(self._path(lock)):
            if self._locked_for(lock) > self.STALE:
                self.delete(lock)  # its writer was lost
            elif time.monotonic() > until:
                raise TimeoutError(f"another writer publishes to {self.path}; if none does, delete {lock}")
            else:
                time.sleep(0.2)
        try:
            yield
        finally:
            self.delete(lock)

    def _locked_for(self, lock: str) -> float:
        found = self._system.globStatus(self._path(lock))
        return time.time() - found[0].getModificationTime() / 1000 if found else 0.0


class Change(Protocol):
    """Something written aside that can be published, and taken back until all changes are."""

    files: Folder

    def publish(self) -> None: ...
    def undo(self) -> None: ...
    def finish(self) -> None: ...
    def discard(self) -> None: ...


class Replacement:
    """The folder ``new`` takes the place of ``at``; without ``new`` it goes."""

    def __init__(self, files: Folder, at: str, new: str | None):
        self.files, self._at, self._new = files, at, new
        self._old: str | None = None

    def publish(self) -> None:
        if self.files.exists(self._at):
            old = self.files.beside(f"old-{uuid.uuid4().hex}")
            self.files.rename(self._at, old)
            self._old = old
        try:
            if self._new:
                self.files.rename(self._new, self._at)
        except Exception:
            self._back()
            raise

    def undo(self) -> None:
        if self._new:
            self.files.rename(self._at, self._new)
        self._back()

    def finish(self) -> None:
        if self._old:
            self.files.delete(self._old)

    def discard(self) -> None:
        if self._new:
            self.files.delete(self._new)

    def _back(self) -> None:
        if self._old:
            self.files.rename(self._old, self._at)
            self._old = None


def publish_all(changes: Sequence[Change]) -> None:
    """Publish changes that are all written: every one, or none if one fails.

    What was there before goes only after the last of them. Folders are locked in the order of their paths, so that two
    jobs never wait for each other.
    """
    folders = {change.files.path: change.files for change in changes}
    with ExitStack() as locks:
        done: list[Change] = []
        try:
            for _, folder in sorted(folders.items()):
                locks.enter_context(folder.locked())
            for change in changes:
                change.publish()
                done.append(change)
        except BaseException:
            for change in reversed(done):
                change.undo()
            for change in changes:
                change.discard()
            raise
        for change in changes:
            change.finish()
