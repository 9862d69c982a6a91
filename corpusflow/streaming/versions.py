"""Tables that are replaced as a whole: each version has a folder, and counts from when it is committed."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Versions:
    """Folders ``v<n>`` below ``root``; an empty file ``_committed/<n>`` makes one readable at once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, n: int) -> str:
        return f"{self.root}/v{n}"

    def committed(self) -> list[int]:
        marks = self._path(f"{self.root}/_committed")
        if not self._fs.exists(marks):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(marks) if s.getPath().getName().isdigit())

    def current(self) -> int | None:
        """The newest version that may be read."""
        return max(self.committed(), default=None)

    def before(self, n: int) -> int | None:
        """The version that a refresh ``n`` goes on from, also if ``n`` was committed before a restart."""
        return max((c for c in self.committed() if c < n), default=None)

    def commit(self, n: int, keep: int = 2) -> None:
        """Make version ``n`` the current one. Those before the last ``keep`` go; a reader has that long to end."""
        self._fs.create(self._path(f"{self.root}/_committed/{n}"), True).close()
        for old in self.committed()[:-keep]:
            self._fs.delete(self._path(f"{self.root}/_committed/{old}"), False)
            self._fs.delete(self._path(self.path(old)), True)
