"""Moving and dropping whole folders, through the file system Spark itself uses.

Folders are never changed in place: new content is written beside them first and
swapped in, and a swap that was cut short is finished by the next one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What a swap replaces waits under such a name, which Spark's readers skip (``_`` would not do: names with = are read).
OLD = ".old-"


class Folders:
    """The file system of ``path``'s scheme."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Folders directly below ``path``, in order; none if it isn't there."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory())

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """Name, size and time of change of every file below ``path``, in order; none if it isn't there."""
        found = []
        if self.exists(path):
            each = self._fs.listFiles(self._path(path), True)
            while each.hasNext():
                status = each.next()
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return sorted(found)

    def drop(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """``source`` becomes ``target``, which must not exist."""
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def swap(self, staged: str | None, target: str) -> None:
        """Put ``staged`` in ``target``'s place, or nothing if it is None.

        The old folder is set aside until the new one is there. Doing it again
        after a crash ends the same: with ``staged`` gone it has been moved.
        """
        parent, name = target.rstrip("/").rsplit("/", 1)
        aside = f"{parent}/{OLD}{name}"
        if staged is None:
            self.drop(target)
        elif self.exists(staged):
            if self.exists(target):
                self.drop(aside)
                self.move(target, aside)
            self.move(staged, target)
        self.drop(aside)

    def restore(self, parent: str) -> None:
        """Give folders back that a swap had set aside when it was cut short."""
        for name in self.names(parent):
            if name.startswith(OLD):
                aside, target = f"{parent}/{name}", f"{parent}/{name.removeprefix(OLD)}"
                if self.exists(target):
                    self.drop(aside)
                else:
                    self.move(aside, target)
