"""State of bounded size that every micro-batch replaces as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlens.session import delete_folder


class FoldedState:
    """A ``foreachBatch`` handler: version n of the table is the version before it merged with
    the state of batch n.

    A batch that is handed in again reads the version before its own and overwrites its own, so
    it counts once; a version counts when its write is complete. The last two versions stay,
    older ones are deleted. Meant for states that stay small: the whole table is
    written by each batch.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str,
        build: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame, DataFrame], DataFrame],
    ):
        self.spark, self.path, self.schema, self._build, self._merge = spark, path, schema, build, merge

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = [v for v in self.versions() if v < batch_id]
        state = self._build(batch)
        if before:
            state = self._merge(self._version(before[-1]), state)
        state.coalesce(1).write.mode("overwrite").parquet(self._folder(batch_id))
        for version in before[:-1]:
            delete_folder(self.spark, self._folder(version))

    def versions(self) -> list[int]:
        """The complete versions, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = [f.getPath().getName() for f in files.listStatus(root)]
        numbers = [int(n.removeprefix("version-")) for n in names if n.startswith("version-")]
        return sorted(n for n in numbers if files.exists(path(f"{self._folder(n)}/_SUCCESS")))

    def read(self) -> DataFrame:
        """The newest version; empty before the first batch."""
        versions = self.versions()
        return self._version(versions[-1]) if versions else self.spark.createDataFrame([], self.schema)

    def _version(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(number))

    def _folder(self, number: int) -> str:
        return f"{self.path}/version-{number}"
