"""Session helpers: UTC, shared scratch space, written intermediates, checked broadcasts."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A side is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 200_000

# A Parquet file below the block size is one split, whatever its rows: a table that few tasks
# wrote is read by as few. Files of at most this many rows spread over all cores.
FILE_ROWS = 100_000

# Removes a query's shuffle files when it ends, and not when the driver next collects garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_open = threading.local()  # intermediates of the open `stages` blocks
_local_dirs: dict[str, str] = {}  # fallback folder per local application


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch arithmetic on NTZ columns needs a session time zone without an offset."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="eventlens-")
    return _local_dirs[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/eventlens/{name}-{uuid.uuid4().hex}"


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session inside the block; afterwards they are what they were."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_spread(df: DataFrame, path: str) -> DataFrame:
    """Overwrite ``path`` with ``df`` in files of at most FILE_ROWS rows, and read it back. The
    shuffle files of the plan go at once, since nothing reads them again."""
    with session_settings(df.sparkSession, {_SHUFFLE_CLEANUP: "true"}):
        df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str = "stage", outlives: bool = False, spread: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and two consumers of the
    result see the same rows even when the plan above is not deterministic. The
    files stay until the `stages` block around the call ends, if there is one; the shuffle
    files of the plan go at once, since nothing reads them again. What ``outlives`` the
    innermost block belongs to the one around it. With ``spread``, see `write_spread`.
    """
    path = fresh_dir(df.sparkSession, name)
    blocks = getattr(_open, "blocks", [])
    for written in (blocks[:-1] if outlives else blocks)[-1:]:
        written.append(path)
    if spread:
        return write_spread(df, path)
    with session_settings(df.sparkSession, {_SHUFFLE_CLEANUP: "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediates written inside the block when it ends.

    For work that leaves its result in a table, such as a micro-batch.
    """
    blocks = _open.__dict__.setdefault("blocks", [])
    blocks.append([])
    try:
        yield
    finally:
        for path in blocks.pop():
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote; nothing happens if it is gone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_or_none(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options,
) -> DataFrame | None:
    """The parquet table at ``path``, or None if nothing was written there yet."""
    reader = (spark.read.schema(schema) if schema else spark.read).options(**options)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def broadcast_if_small(df: DataFrame, rows: int) -> tuple[DataFrame, bool]:
    """Hint a broadcast of a side whose rows were counted, if the count allows it."""
    if rows <= BROADCAST_ROWS:
        return F.broadcast(df), True
    return df, False
