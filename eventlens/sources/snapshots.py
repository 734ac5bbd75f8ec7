"""Versioned metric state on shared storage: base versions, batch partials, compaction.

Layout below ``path``::

    manifest/                     one row per complete base version
    base/version=N/{partials,samples}
    batches/batch_id=B/{partials,samples}

A base version exists once its manifest row does, so a half-written one is never
read. ``high_water`` is the last batch folded into it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, functions as F, types as T

from eventlens.operators.state import MetricState, PARTIAL_SCHEMA, empty_state, merge_states
from eventlens.session import delete_folder, read_or_none

MANIFEST = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("high_water", T.LongType()),
    T.StructField("folder", T.StringType()),
])
BATCH_ROW = T.StructType([T.StructField("batch_id", T.LongType())])


class StateTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- batches ---

    def write_batch(self, batch_id: int, state: MetricState) -> None:
        """Store the state of one batch. A retried batch overwrites itself; the marker
        row is written last, so a batch is read only once it is complete."""
        folder = f"{self.path}/batches/batch_id={batch_id}"
        state.partials.write.mode("overwrite").parquet(f"{folder}/partials")
        state.samples.write.mode("overwrite").parquet(f"{folder}/samples")
        self._mark(f"{folder}/done", BATCH_ROW, batch_id)

    def _mark(self, path: str, schema: T.StructType, *values) -> None:
        row = self.spark.createDataFrame([values], schema)
        row.write.mode("overwrite").parquet(path)

    def batch_ids(self, after: int) -> list[int]:
        """Complete batches newer than ``after``. Compaction keeps this list short."""
        done = read_or_none(self.spark, f"{self.path}/batches/*/done", BATCH_ROW)
        if done is None:
            return []
        return sorted(r.batch_id for r in done.where(F.col("batch_id") > after).collect())

    # --- base versions ---

    def latest(self):
        """Newest manifest row, or None."""
        manifest = read_or_none(self.spark, f"{self.path}/manifest", MANIFEST)
        return None if manifest is None else manifest.orderBy(F.desc("version")).first()

    def write_base(self, state: MetricState, high_water: int = -1) -> int:
        """Write a new base version and switch readers to it."""
        last = self.latest()
        version = last.version + 1 if last else 0
        folder = f"{self.path}/base/version={version}-{uuid.uuid4().hex}"
        state.partials.write.partitionBy("kind").parquet(f"{folder}/partials")
        state.samples.write.parquet(f"{folder}/samples")
        row = self.spark.createDataFrame([(version, high_water, folder)], MANIFEST)
        row.write.mode("append").parquet(f"{self.path}/manifest")
        return version

    # --- reading ---

    def read(self) -> MetricState:
        """Base plus every newer batch, merged; the empty state when nothing was written."""
        last = self.latest()
        return self._merged(last, self.batch_ids(last.high_water if last else -1))

    def _merged(self, last, ids: list[int]) -> MetricState:
        parts = [self._load(last.folder)] if last else []
        if ids:
            folders = [f"{self.path}/batches/batch_id={i}" for i in ids]
            parts.append(MetricState(
                self.spark.read.schema(PARTIAL_SCHEMA).parquet(*[f"{f}/partials" for f in folders]),
                self.spark.read.parquet(*[f"{f}/samples" for f in folders]),
            ))
        if not parts:
            return empty_state(self.spark)
        # One base alone is already merged; batches may share keys.
        return merge_states(*parts) if ids else parts[0]

    def _load(self, folder: str) -> MetricState:
        partials = self.spark.read.schema(PARTIAL_SCHEMA).parquet(f"{folder}/partials")
        return MetricState(
            partials.select(*PARTIAL_SCHEMA.names), self.spark.read.parquet(f"{folder}/samples")
        )

    def compact(self) -> int:
        """Fold all complete batches into a new base version; readers then skip them."""
        last = self.latest()
        ids = self.batch_ids(last.high_water if last else -1)
        high_water = ids[-1] if ids else (last.high_water if last else -1)
        return self.write_base(self._merged(last, ids), high_water)

    def drop_folded(self) -> None:
        """Delete what no reader needs any more: batches folded into the base before the
        newest one, and the bases before that. Readers of the last two bases go on."""
        manifest = read_or_none(self.spark, f"{self.path}/manifest", MANIFEST)
        bases = [] if manifest is None else manifest.orderBy(F.desc("version")).collect()
        if len(bases) < 2:
            return
        done = read_or_none(self.spark, f"{self.path}/batches/*/done", BATCH_ROW)
        if done is not None:
            for row in done.where(F.col("batch_id") <= bases[1].high_water).collect():
                delete_folder(self.spark, f"{self.path}/batches/batch_id={row.batch_id}")
        for base in bases[2:]:
            delete_folder(self.spark, base.folder)
