"""An event log whose appends may be retried, and readers that take a bounded number of events.

Layout below ``path``::

    data/attempt=A/partition_id=P/   the rows of one try to append
    files/attempt=A/                 a row for each of its files: rows, bytes, first and last offset
    commits/N.json                   the attempts that count, in order
    consumers/NAME/                  what a reader has planned and finished

A commit is one small file, created last and only if no other one has its number: it names
the attempt and the batch, and carries the first and next offset of every partition. So an
append that died leaves rows nobody reads, a repeated batch finds its commit, and two writers
can not both take the next offsets. Offsets, statistics and retention come from commits and
from the table of files; the log itself is not read for them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.session import delete_folder, materialize, read_or_none
from eventlens.sources.event_log import ARRIVAL, LOG_MAX_BYTES, assign_offsets, log_lines, route

POLL_EVENTS = 256  # fixed value: events of a partition that one poll takes at most
ROUND_POLLS = 4096  # polls that a reader behind by many takes in one job at most
_FILES = "attempt string, partition_id int, file string, rows long, bytes long, first_offset long, end_offset long"


class CommitConflict(Exception):
    """Another writer committed first; the append may be tried again."""


class _Records:
    """A folder of small numbered JSON files."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def last(self) -> int:
        """The largest number, -1 in an empty folder."""
        if not self._fs.exists(self._folder):
            return -1
        names = (f.getPath().getName() for f in self._fs.listStatus(self._folder))
        return max((int(n.split(".")[0]) for n in names if n[0].isdigit()), default=-1)

    def get(self, number: int) -> dict:
        stream = self._fs.open(self._spark._jvm.org.apache.hadoop.fs.Path(self._folder, f"{number}.json"))
        try:
            return json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, number: int, value: dict) -> bool:
        """Whether the file is new. It appears with its content: written aside, then renamed."""
        jvm = self._spark._jvm
        aside = jvm.org.apache.hadoop.fs.Path(self._folder, f"_{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(self._folder, f"{number}.json")
        try:
            # FileContext refuses to rename onto a file that exists; FileSystem may replace it.
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                self._fs.getUri(), self._spark._jsc.hadoopConfiguration())
            no_options = self._spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(aside, target, no_options)
        except Exception as error:
            self._fs.delete(aside, False)
            if self._fs.exists(target):
                return False
            raise error
        return True


class CommittedLog:
    """The log at ``path``; the number of partitions is fixed by its first commit."""

    def __init__(self, spark: SparkSession, path: str, partitions: int):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions
        self._commits = _Records(spark, f"{self.path}/commits")

    # --- state ---

    def _head(self) -> tuple[int, dict]:
        """(number, content) of the newest commit."""
        number = self._commits.last()
        empty = {"bases": [0] * self.partitions, "ends": [0] * self.partitions}
        head = self._commits.get(number) if number >= 0 else empty
        if len(head["ends"]) != self.partitions:
            raise ValueError(f"the log has {len(head['ends'])} partitions")
        return number, head

    def _offsets(self, which: str, name: str) -> DataFrame:
        values = self._head()[1][which]
        return self.spark.createDataFrame([*enumerate(values)], f"partition_id int, {name} long")

    def ends(self) -> DataFrame:
        """(partition_id, end_offset): the next offset of every partition, empty ones included."""
        return self._offsets("ends", "end_offset")

    def commits(self) -> DataFrame | None:
        """One row per commit: number, batch, writer and attempt."""
        try:
            found = self.spark.read.schema(
                "number long, writer string, batch_id long, attempt string").json(f"{self.path}/commits/[0-9]*.json")
        except Exception:
            if self._commits.last() < 0:
                return None
            raise
        return found

    def _attempts(self, upto: int | None = None) -> list[str]:
        """The attempts that count, one a commit."""
        found = self.commits()
        if found is None:
            return []
        found = found.where("attempt is not null")
        return [r.attempt for r in (found if upto is None else found.where(F.col("number") <= upto)).collect()]

    def files(self) -> DataFrame:
        """The files of committed attempts."""
        attempts = self._attempts()
        every = read_or_none(self.spark, f"{self.path}/files", _FILES) if attempts else None
        if every is None:
            return self.spark.createDataFrame([], _FILES)
        counted = self.spark.createDataFrame([(a,) for a in attempts], "attempt string")
        return every.join(F.broadcast(counted), "attempt", "left_semi")

    # --- append ---

    def number(self, events: DataFrame, arrival: list[str] = ARRIVAL, keyless: bool = True) -> DataFrame:
        """The rows of a batch with their partition and, as offset, their place in it. Tries to append
        a batch can share it (``numbered``): the sort of the batch is written once."""
        return assign_offsets(route(events, self.partitions, arrival, keyless), arrival)

    def write_attempt(
        self, events: DataFrame, arrival: list[str] = ARRIVAL, keyless: bool = True, numbered: bool = False,
    ) -> dict:
        """Write the rows with the offsets they would get, not yet part of the log."""
        number, head = self._head()
        attempt = uuid.uuid4().hex
        ends = self.spark.createDataFrame([*enumerate(head["ends"])], "partition_id int, end_offset long")
        places = events if numbered else self.number(events, arrival, keyless)
        placed = places.join(F.broadcast(ends), "partition_id").withColumn(
            "offset", F.col("offset") + F.col("end_offset")).select(*places.columns)
        folder = f"{self.path}/data/attempt={attempt}"
        placed.sortWithinPartitions("partition_id", "offset").write.partitionBy("partition_id").parquet(folder)
        # partition_id is a string to Spark's writer and comes back as a number.
        written = self.spark.read.option("basePath", folder).schema(placed.schema).parquet(folder)
        files = materialize(written.groupBy("partition_id", F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("rows"), F.sum(F.octet_length(log_lines(written)) + 1).alias("bytes"),
            F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")), "files")
        files.write.parquet(f"{self.path}/files/attempt={attempt}")
        grown = {r.partition_id: r.end for r in files.groupBy("partition_id").agg(F.max("end_offset").alias("end")).collect()}
        return {"number": number + 1, "attempt": attempt, "bases": head["bases"],
                "ends": [grown.get(p, end) for p, end in enumerate(head["ends"])]}

    def append(
        self, events: DataFrame, batch_id: int | None = None, writer: str = "main", arrival: list[str] = ARRIVAL,
        keyless: bool = True, numbered: bool = False,
    ) -> bool:
        """Append a batch once, however often it is tried; False if it was there already.

        Batches are told apart by writer and id; without an id every call appends.
        """
        if batch_id is not None and self.has(batch_id, writer):
            return False
        commit = self.write_attempt(events, arrival, keyless, numbered)
        if not self._commits.create(commit["number"], commit | {"batch_id": batch_id, "writer": writer}):
            delete_folder(self.spark, f"{self.path}/data/attempt={commit['attempt']}")
            delete_folder(self.spark, f"{self.path}/files/attempt={commit['attempt']}")
            raise CommitConflict(f"commit {commit['number']} of {self.path} is another writer's")
        return True

    def has(self, batch_id: int, writer: str = "main") -> bool:
        found = self.commits()
        return found is not None and not found.where(
            (F.col("batch_id") == batch_id) & (F.col("writer") == writer)).isEmpty()

    def handler(self, writer: str = "main", **options) -> Callable[[DataFrame, int], None]:
        """foreachBatch handler that appends each micro-batch once."""
        return lambda batch, batch_id: self.append(batch, batch_id, writer, **options)

    def drop_uncommitted(self) -> int:
        """Delete what dead attempts left behind. Not while a writer is at work."""
        kept, jvm, dropped = set(self._attempts()), self.spark._jvm, 0
        for kind in ("data", "files"):
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
            fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for f in fs.listStatus(folder) if fs.exists(folder) else []:
                if f.getPath().getName().removeprefix("attempt=") not in kept:
                    fs.delete(f.getPath(), True)
                    dropped += kind == "data"
        return dropped

    # --- reading ---

    def read(self) -> DataFrame | None:
        """The committed rows from the base offsets on, None before the first commit with rows."""
        head = self._head()[1]
        folders = [f"{self.path}/data/attempt={a}" for a in self._attempts()]
        rows = None if not folders else self._folders(folders)
        if rows is None or not any(head["bases"]):
            return rows
        bases = self.spark.createDataFrame([*enumerate(head["bases"])], "partition_id int, _base long")
        return rows.join(F.broadcast(bases), "partition_id").where(F.col("offset") >= F.col("_base")).select(*rows.columns)

    def _folders(self, folders: list[str]) -> DataFrame | None:
        found = [f for f in folders if self._has_rows(f)]
        if not found:
            return None
        return self.load(found)

    def load(self, paths: list[str]) -> DataFrame:
        """The rows of data folders or files. Appends may differ in their columns."""
        whole = self.spark.read.option("basePath", f"{self.path}/data").option("mergeSchema", True).parquet(*paths)
        return whole.drop("attempt").withColumn("partition_id", F.col("partition_id").cast("int"))

    def _has_rows(self, folder: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.exists(where) and any(f.isDirectory() for f in fs.listStatus(where))

    # --- retention and statistics ---

    def rotate(self, max_bytes: int = LOG_MAX_BYTES) -> list[int]:
        """Drop the older half of every partition that reached the cap; the new base offsets.

        One commit moves the bases, which readers start from; then the files that lie below
        them go. A file that a base cuts stays. Its dropped rows count for the cap by their
        share of the file's bytes.
        """
        number, head = self._head()
        bases = self.spark.createDataFrame([*enumerate(head["bases"])], "partition_id int, base long")
        share = F.least(F.lit(1.0), (F.col("end_offset") - F.col("base")) / F.col("rows"))
        live = self.files().join(F.broadcast(bases), "partition_id").where(F.col("end_offset") > F.col("base"))
        sizes = live.groupBy("partition_id").agg(F.sum(F.col("bytes") * share).alias("bytes")).collect()
        new = list(head["bases"])
        for r in sizes:
            held = head["ends"][r.partition_id] - new[r.partition_id]
            if r.bytes >= max_bytes and held >= 2:
                new[r.partition_id] += held // 2
        if new != head["bases"]:
            if not self._commits.create(number + 1, head | {
                    "number": number + 1, "bases": new, "attempt": None, "batch_id": None, "writer": "retention"}):
                raise CommitConflict(f"commit {number + 1} of {self.path} is another writer's")
            self._drop_below(new)
        return new

    def _drop_below(self, bases: list[int]) -> None:
        frame = self.spark.createDataFrame([*enumerate(bases)], "partition_id int, base long")
        below = self.files().join(F.broadcast(frame), "partition_id").where(F.col("end_offset") <= F.col("base"))
        for r in below.select("file").toLocalIterator():
            delete_folder(self.spark, r.file)

    def stats(self, consumer: str | None = None) -> DataFrame:
        """Offsets, lag and volumes of every partition; consumed is what ``consumer`` finished, and
        backpressure events are those that a poll left waiting when they first were there."""
        head = self._head()[1]
        reader = Consumer(self, consumer) if consumer else None
        done, held = (reader.position(), reader.held()) if reader else ([0] * self.partitions,) * 2
        rows = [(p, b, e, c, e - c, e, c, h) for p, (b, e, c, h) in enumerate(zip(head["bases"], head["ends"], done, held))]
        return self.spark.createDataFrame(
            rows, "partition_id int, base_offset long, end_offset long, committed_offset long, lag long, "
                  "total_produced long, total_consumed long, backpressure_events long")


class Consumer:
    """A reader that takes at most ``max_events`` of each partition at a time.

    A poll's ranges are written before its rows are handed out, and marked when the handler
    returns. After a restart an unfinished poll is repeated with the same ranges, under the
    same number.

    A reader that is many polls behind can take them in rounds: consecutive polls, each with the
    events it would have had by itself, handed out as one frame and finished together.
    """

    def __init__(self, log: CommittedLog, name: str, max_events: int = POLL_EVENTS):
        self.log, self.max_events = log, max_events
        self._plans = _Records(log.spark, f"{log.path}/consumers/{name}/plans")
        self._done = _Records(log.spark, f"{log.path}/consumers/{name}/done")

    def position(self) -> list[int]:
        """The next offset of each partition after the finished polls."""
        number = self._done.last()
        if number < 0:
            return [0] * self.log.partitions
        return self._plans.get(self._done.get(number).get("plan", number))["to"]

    def held(self) -> list[int]:
        """How many events of each partition had to wait for more than one poll so far."""
        number = self._plans.last()
        return self._plans.get(number).get("held", [0] * self.log.partitions) if number >= 0 else [0] * self.log.partitions

    def plan(self, polls: int = 1) -> tuple[int, dict] | None:
        """(number, ranges) of the next poll, or the first of a round of up to ``polls`` polls; None if
        nothing is waiting. What was planned and not finished comes as it was planned."""
        number = self._done.last() + 1
        if self._plans.last() >= number:
            return number, self._plans.get(number)
        head = self.log._head()[1]
        start = [max(a, b) for a, b in zip(self.position(), head["bases"])]
        most = max(0, *(e - a for a, e in zip(start, head["ends"])))
        if not most:
            return None
        polls = min(polls, -(-most // self.max_events))
        first, to = ([min(a + n * self.max_events, e) for a, e in zip(start, head["ends"])] for n in (1, polls))
        last = self._plans.get(self._plans.last()) if number else {}
        nothing = [0] * self.log.partitions
        # events that this poll is the first to see and leaves waiting
        held = [h + max(0, e - max(t, seen)) for h, e, t, seen in zip(
            last.get("held", nothing), head["ends"], first, last.get("ends", nothing))]
        ranges = {"from": start, "to": to, "behind": [e - a for a, e in zip(start, head["ends"])],
                  "ends": head["ends"], "held": held, "polls": polls, "size": self.max_events}
        if not self._plans.create(number, ranges):
            raise CommitConflict("two readers use one consumer name")
        return number, ranges

    def rows(self, ranges: dict, first: int | None = None) -> DataFrame:
        """The events of planned ranges: only the folders and files that hold them are read. With the
        number of the ``first`` poll, each has its own in the column ``poll``."""
        taken = [(p, a, b) for p, (a, b) in enumerate(zip(ranges["from"], ranges["to"])) if b > a]
        bounds = self.log.spark.createDataFrame(taken, "partition_id int, _a long, _b long")
        files = self.log.files().join(F.broadcast(bounds), "partition_id").where(
            (F.col("first_offset") < F.col("_b")) & (F.col("end_offset") > F.col("_a")))
        rows = self.log.load([r.file for r in files.select("file").collect()])  # those of one poll
        taken = rows.join(F.broadcast(bounds), "partition_id").where(F.col("offset").between(F.col("_a"), F.col("_b") - 1))
        if first is None:
            return taken.select(*rows.columns)
        size = ranges.get("size", self.max_events)
        return taken.select(*rows.columns, F.expr(f"{first} + (offset - _a) div {size}").alias("poll"))

    def poll(self, handle: Callable[[DataFrame, int], None]) -> bool:
        """Hand the next events and the poll's number to ``handle``; False if there are none."""
        planned = self.plan()
        if planned is None:
            return False
        number, ranges = planned
        if ranges.get("polls", 1) > 1:
            raise CommitConflict(f"a round of polls from {number} on is not finished")
        handle(self.rows(ranges), number)
        self._done.create(number, {"plan": number})
        return True

    def poll_round(self, handle: Callable[[DataFrame, int], None], polls: int = ROUND_POLLS) -> int:
        """Hand the events of the next ``polls`` polls or fewer to ``handle`` at once, with their poll's
        number in the column ``poll``, and the number of the first; how many polls these were."""
        planned = self.plan(polls)
        if planned is None:
            return 0
        number, ranges = planned
        count = ranges.get("polls", 1)
        handle(self.rows(ranges, number), number)
        self._done.create(number + count - 1, {"plan": number})
        return count

    def run(self, handle: Callable[[DataFrame, int], None]) -> int:
        """Poll until nothing waits; the number of polls."""
        count = 0
        while self.poll(handle):
            count += 1
        return count

    def run_rounds(self, handle: Callable[[DataFrame, int], None], polls: int = ROUND_POLLS) -> int:
        """Like `run`, in rounds: the jobs follow the volume and not the number of polls."""
        count = 0
        while done := self.poll_round(handle, polls):
            count += done
        return count
