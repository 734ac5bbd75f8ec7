"""Composable filter / map / aggregate / sink chain over a DataFrame.

Steps are Column functions, so the chain is one logical plan that Spark fuses and
pushes down. A step written for event objects works unchanged as long as it
builds an expression: ``lambda e: e.event_type == "purchase"`` and
``lambda e: e.data.get("amount", 0)`` receive an ``EventColumns``.
"""

from __future__ import annotations

import statistics
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventlens.operators.quantiles import medians
from eventlens.schema import PAYLOAD, RAW_PAYLOAD

VALUE = "value"
_HELD_WINDOWS = 50_000  # window states a task holds before it passes them on

# Python aggregates and the Spark aggregates that compute them.
_BUILT_IN = {
    sum: F.sum, len: F.count, min: F.min, max: F.max,
    statistics.mean: F.avg, statistics.median: F.median,
    "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg, "median": F.median,
}


_KINDS = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType()}


class PayloadColumns:
    """``e.data``: payload fields with a default, as in a dict. A key without a column is read
    from the raw payload, if the frame has it: as a string, or in the type of its default."""

    def __init__(self, fields: list[str], nested: bool, raw: bool = False):
        self._fields, self._nested, self._raw = fields, nested, raw

    def get(self, key: str, default=None) -> Column:
        if key in self._fields:
            found = F.col(f"data.{key}" if self._nested else key)
        elif self._raw:
            kind = PAYLOAD[key].dataType if key in PAYLOAD.names else _KINDS.get(type(default), T.StringType())
            text = F.from_json(RAW_PAYLOAD, T.StructType([T.StructField(key, T.StringType())])).getField(key)
            found = text.try_cast(kind)
        else:
            return F.lit(default)
        return found if default is None else F.coalesce(found, F.lit(default))

    def __getitem__(self, key: str) -> Column:
        return self.get(key)

    def has(self, key: str) -> Column:
        return self.get(key).isNotNull()


class EventColumns:
    """Event attributes as columns of the frame."""

    def __init__(self, df: DataFrame):
        nested = "data" in df.columns
        self.data = PayloadColumns(
            df.schema["data"].dataType.names if nested else df.columns, nested, RAW_PAYLOAD in df.columns)
        # Flat rows call the event time `ts`.
        self._renamed = {} if "timestamp" in df.columns else {"timestamp": "ts"}

    def __getattr__(self, name: str) -> Column:
        return F.col(self._renamed.get(name, name))


@dataclass(frozen=True)
class MergeableAgg:
    """A custom window aggregate that is computed in parts.

    ``partial`` turns a pandas Series of values into a state tuple, ``merge`` joins
    two states, ``finish`` makes the result. No task ever holds all values of a
    window: a task keeps one state per window it has seen.
    """

    state_schema: str
    partial: Callable[[pd.Series], tuple]
    merge: Callable[[tuple, tuple], tuple]
    finish: Callable[[tuple], object]
    result_type: str = "double"


@dataclass(frozen=True)
class PipelineResult:
    """What a pipeline makes of a frame: the values that reach the end, and one
    table per aggregate step."""

    output: DataFrame
    windows: list[DataFrame] = field(default_factory=list)


class Pipeline:
    def __init__(self, time_col: str = "ingest_ts"):
        self.time_col = time_col
        self._steps: list[tuple] = []
        self._sink: Callable[[DataFrame], object] | None = None

    def filter(self, predicate: Callable | Column) -> "Pipeline":
        """Keep rows for which the predicate is true."""
        self._steps.append(("filter", predicate))
        return self

    def map(self, transform: Callable | Column) -> "Pipeline":
        """Replace each row by a value; a null value drops the row."""
        self._steps.append(("map", transform))
        return self

    def aggregate(self, window_seconds: float, fn, emit: Callable[[DataFrame], object] | None = None) -> "Pipeline":
        """Tumbling-window aggregate of the current values, which also flow on.

        ``fn``: sum, len, min, max, a mean or median, a function from a Column to
        an aggregate Column, or a ``MergeableAgg`` (on streams: inside foreachBatch).
        ``emit`` receives the table.
        """
        self._steps.append(("aggregate", window_seconds, fn, emit))
        return self

    def sink(self, write: Callable[[DataFrame], object]) -> "Pipeline":
        """Where the remaining rows go, e.g. ``lambda df: df.write.parquet(path)``."""
        self._sink = write
        return self

    def apply(self, df: DataFrame) -> PipelineResult:
        """Build the plan for a static or streaming frame; nothing runs yet."""
        mapped, windows = False, []
        for kind, *args in self._steps:
            if kind == "filter":
                df = df.where(_expression(args[0], df, mapped))
            elif kind == "map":
                value = _expression(args[0], df, mapped)
                keep = [self.time_col] if self.time_col in df.columns else []
                df = df.select(*keep, value.alias(VALUE)).where(F.col(VALUE).isNotNull())
                mapped = True
            else:
                windows.append(window_aggregate(df, self.time_col, args[0], args[1], VALUE if mapped else None))
        if mapped:
            df = df.select(VALUE)
        return PipelineResult(df, windows)

    def process_batch(self, df: DataFrame) -> PipelineResult:
        """Run the chain on a batch or micro-batch, feeding sink and emit callbacks."""
        result = self.apply(df)
        emits = [step[3] for step in self._steps if step[0] == "aggregate"]
        for emit, table in zip(emits, result.windows):
            if emit:
                emit(table)
        if self._sink:
            self._sink(result.output)
        return result


def _expression(step, df: DataFrame, mapped: bool) -> Column:
    if isinstance(step, Column):
        return step
    made = step(F.col(VALUE) if mapped else EventColumns(df))
    return made if isinstance(made, Column) else F.lit(made)


def python_predicate(fn: Callable[[pd.DataFrame], pd.Series], *cols: str) -> Column:
    """Escape hatch for filters that no expression can state: ``fn`` sees Arrow
    batches as pandas frames. It blocks predicate pushdown."""
    return python_map(fn, "boolean", *cols)


def python_map(fn: Callable[[pd.DataFrame], pd.Series], return_type: str, *cols: str) -> Column:
    """Escape hatch for maps, vectorised in the same way."""

    @F.pandas_udf(return_type)
    def apply(batch: pd.DataFrame) -> pd.Series:
        return fn(batch)

    return apply(F.struct(*cols))


def window_aggregate(df: DataFrame, time_col: str, window_seconds: float, fn, value_col: str | None = VALUE) -> DataFrame:
    """(window_start, window_end, result, count) of tumbling windows aligned to the epoch."""
    value = F.col(value_col) if value_col else F.lit(1)
    window = F.window(time_col, f"{int(window_seconds * 1_000_000)} microseconds")
    if isinstance(fn, MergeableAgg):
        if value_col is None:
            raise ValueError("map the events to values before a custom aggregate")
        return _merge_windows(df.select(window.alias("w"), value.alias(VALUE)), fn)
    aggregate = _BUILT_IN.get(fn, fn)
    if aggregate is F.median and not df.isStreaming:
        return _median_windows(df.select(window.alias("w"), value.alias(VALUE)))
    return (
        df.groupBy(window.alias("w"))
        .agg(aggregate(value).alias("result"), F.count("*").alias("count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "result", "count")
    )


def _median_windows(df: DataFrame) -> DataFrame:
    """Medians by exact selection: Spark's own median brings all values of a window to one task."""
    counts = df.groupBy("w").agg(F.count("*").alias("count"))
    found = medians(df, ["w"], VALUE).select(F.col("w").alias("_w"), F.col("median").alias("result"))
    return counts.join(found, F.col("w") == F.col("_w"), "left").select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "result", "count")


def _merge_windows(df: DataFrame, agg: MergeableAgg) -> DataFrame:
    """Partial states inside each input task, then a merge of the states by window.

    A window sends about one state row per task over the shuffle. The merge reads
    them in window order and holds one state at a time.
    """
    state = T.StructType.fromDDL(agg.state_schema)
    partial_type = T.StructType([
        T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
        T.StructField("count", T.LongType()), *state.fields,
    ])
    result_type = T.StructType([
        *partial_type.fields[:2],
        T.StructField("result", T.StructType.fromDDL(f"r {agg.result_type}")[0].dataType),
        T.StructField("count", T.LongType()),
    ])

    # The tasks get plain functions and names, so workers need not import this package.
    partial, merge, finish, limit = agg.partial, agg.merge, agg.finish, _HELD_WINDOWS
    partial_names, result_names = partial_type.names, result_type.names

    def join(known: tuple | None, count: int, values: tuple) -> tuple:
        return (count, values) if known is None else (known[0] + count, merge(known[1], values))

    def rows(held: dict) -> pd.DataFrame:
        return pd.DataFrame(
            [(*key, count, *values) for key, (count, values) in held.items()], columns=partial_names
        )

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for key, values in batch.groupby(["window_start", "window_end"])[VALUE]:
                held[key] = join(held.get(key), len(values), partial(values))
            if len(held) > limit:
                yield rows(held)
                held = {}
        yield rows(held)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, known = None, None
        for batch in batches:
            done = []
            for start, end, count, *values in batch.itertuples(index=False, name=None):
                if key is not None and key != (start, end):
                    done.append((*key, finish(known[1]), known[0]))
                    known = None
                key, known = (start, end), join(known, count, tuple(values))
            yield pd.DataFrame(done, columns=result_names)
        if key is not None:
            yield pd.DataFrame([(*key, finish(known[1]), known[0])], columns=result_names)

    flat = df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), VALUE)
    return (
        flat.mapInPandas(partials, partial_type)
        .repartition("window_start", "window_end")
        .sortWithinPartitions("window_start", "window_end")
        .mapInPandas(merged, result_type)
    )
