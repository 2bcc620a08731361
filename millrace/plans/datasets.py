"""Declared datasets: each names its inputs, its rules and how it is built from them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import scratch
from millrace.operators import cdc, eventlog
from millrace.operators.lineage import column_sources
from millrace.operators.quality import Rule, apply_rules, count_names
from millrace.streaming.changes import apply_changes, fold_when_due, read_current, read_history
from millrace.streaming.flows import is_published, publish_batch, read_batches, staging_folder, start, write_batch

STORED, STREAMED, CHANGES, VIEW = "complete", "append", "changes", "view"
_EVENTS, _BATCH_EVENTS = "_events", "_batch_events"
_LOG = "event_type STRING, flow_name STRING, details STRING"


@dataclass(frozen=True)
class Dataset:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame] | None
    rules: tuple[Rule, ...]
    kind: str
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    apply: Mapping[str, object] = field(default_factory=dict)
    columns: Mapping[str, Sequence[str]] = field(default_factory=dict)


class DatasetGraph:
    """Datasets in any order; inputs decide the order they are built in.

    A stored dataset is recomputed and rewritten on every run. A streamed one appends only what
    is new upstream. A changes dataset applies a streamed feed by key. A view is a plain frame.
    Each run appends its definitions, row counts and rule counts to the event log below the
    folder; a stream logs every micro-batch by its batch id, as long as it runs, and a batch that is
    replayed counts once. A definition says which input columns each column comes from: those declared under
    ``columns`` (``{"revenue": "silver.amount"}``, or a list), else those that the plan of its build
    leads to.
    """

    def __init__(self) -> None:
        self._datasets: dict[str, Dataset] = {}
        #: Streams of the last run by dataset; those of an interval trigger go on running.
        self.queries: dict[str, StreamingQuery] = {}

    def _add(self, dataset: Dataset) -> None:
        if dataset.name in self._datasets:
            raise ValueError(f"dataset {dataset.name} is declared twice")
        self._datasets[dataset.name] = dataset

    def _declare(self, kind, name, inputs, rules, comment, properties, columns) -> Callable:
        sources = {c: [s] if isinstance(s, str) else list(s) for c, s in (columns or {}).items()}

        def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self._add(
                Dataset(
                    name, tuple(inputs), build, tuple(rules), kind, comment,
                    dict(properties or {}), columns=sources,
                )
            )
            return build

        return register

    def stored(self, name, inputs=(), rules=(), comment="", properties=None, columns=None):
        return self._declare(STORED, name, inputs, rules, comment, properties, columns)

    def streamed(self, name, inputs=(), rules=(), comment="", properties=None, columns=None):
        return self._declare(STREAMED, name, inputs, rules, comment, properties, columns)

    def view(self, name, inputs=(), rules=(), comment="", properties=None, columns=None):
        return self._declare(VIEW, name, inputs, rules, comment, properties, columns)

    def changes(
        self,
        name: str,
        feed: str,
        *,
        keys: Sequence[str],
        sequence_by: str,
        delete_when: str | None = None,
        truncate_when: str | None = None,
        except_cols: Sequence[str] = (),
        scd: int = 1,
        comment: str = "",
        properties: Mapping[str, str] | None = None,
    ) -> None:
        """Declare the current state (``scd=1``) or the history (``scd=2``) of a streamed feed.

        Stored changes are folded into a new base after a run that made them outgrow the old one.
        """
        sequence = [f"{feed}.{sequence_by}"]
        apply = {
            "keys": list(keys),
            "sequence_by": sequence_by,
            "delete_when": delete_when,
            "truncate_when": truncate_when,
            "except_cols": list(except_cols),
            "scd": scd,
        }
        self._add(
            Dataset(
                name, (feed,), None, (), CHANGES, comment, dict(properties or {}), apply,
                {cdc.START: sequence, cdc.END: sequence} if scd == 2 else {},
            )
        )

    def order(self) -> list[Dataset]:
        """Build order; a cycle raises ``graphlib.CycleError``."""
        graph = {d.name: d.inputs for d in self._datasets.values()}
        names = TopologicalSorter(graph).static_order()
        return [self._datasets[n] for n in names if n in self._datasets]

    def edges(self) -> list[tuple[str, str]]:
        return [(source, d.name) for d in self.order() for source in d.inputs]

    def run(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        folder: str,
        trigger: str = "availableNow",
        logged_at: datetime | None = None,
    ) -> dict[str, DataFrame]:
        """Bring every dataset up to date and return them by name.

        ``sources`` holds the frames from outside, streaming ones for streamed datasets. The
        folder keeps data and checkpoints; a full refresh is a run on a new folder. A trigger
        other than ``availableNow`` leaves the streams running after their first pass. A backfill
        names the time (UTC) that it stands for in ``logged_at``; the log has the present otherwise.
        """
        frames = dict(sources)
        update = _Update(uuid.uuid4().hex, logged_at)
        self.queries = {}
        log, traced = [], {}
        for dataset in self.order():
            if dataset.kind == STREAMED:
                frame, counts = self._run_streamed(
                    spark, dataset, frames, folder, trigger, update, traced
                )
            elif dataset.kind == CHANGES:
                frame, counts = self._run_changes(spark, dataset, frames, folder, trigger)
            else:
                frame, counts = self._run_batch(spark, dataset, frames, folder, traced)
            frames[dataset.name] = frame
            log.extend(_log_rows(dataset, frames, counts, traced.get(dataset.name)))
        rows = [(eventlog.UPDATE, None, json.dumps({eventlog.UPDATE: {"update_id": update.id}}))]
        update.entries(spark, rows + log).write.mode("append").parquet(f"{folder}/{_EVENTS}")
        return frames

    def _follow(self, spark, frames, folder: str, name: str) -> DataFrame:
        """The input as a stream; only append-only inputs can be followed."""
        frame = frames[name]
        if frame.isStreaming:
            return frame
        if name not in self._datasets or self._datasets[name].kind != STREAMED:
            raise ValueError(f"{name} is not append-only, so it cannot be read as a stream")
        schema = T.StructType(frame.schema.fields + [T.StructField("batch_id", T.LongType())])
        return spark.readStream.schema(schema).parquet(f"{folder}/{name}").drop("batch_id")

    def _run_batch(self, spark, dataset, frames, folder, traced):
        seen = Observation() if dataset.kind == STORED else None
        rows = dataset.build(*[frames[i] for i in dataset.inputs])
        traced[dataset.name] = column_sources(rows, {i: frames[i] for i in dataset.inputs})
        rows = apply_rules(rows, dataset.rules, seen)
        if dataset.kind == STORED:
            path = f"{folder}/{dataset.name}"
            rows.write.mode("overwrite").parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
        return rows, seen.get if seen is not None else None

    def _run_streamed(self, spark, dataset, frames, folder, trigger, update, traced):
        """Each batch is staged under the rules, its counts are logged, then it is published.

        Counts are observed by the pass that stages the rows. They are written once by batch id, and
        so is the batch, so a replay finds what is done already. A run without news logs zeros.
        """
        path = f"{folder}/{dataset.name}"
        inputs = [self._follow(spark, frames, folder, i) for i in dataset.inputs]
        rows = dataset.build(*inputs)
        traced[dataset.name] = column_sources(rows, dict(zip(dataset.inputs, inputs)))
        scratch.make_dir(spark, path)
        seen_batches = []

        def load(batch: DataFrame, batch_id: int) -> None:
            seen_batches.append(batch_id)
            del seen_batches[:-1]
            if is_published(spark, path, batch_id):
                return
            seen = Observation()
            checked = apply_rules(batch, dataset.rules, seen)
            checked.write.mode("overwrite").parquet(staging_folder(path, batch_id))
            entry = update.entries(spark, [_progress_row(dataset, seen.get, batch_id)])
            write_batch(entry, f"{folder}/{_BATCH_EVENTS}/flow={dataset.name}", batch_id)
            publish_batch(spark, path, batch_id)

        checkpoint = f"{folder}/_checkpoints/{dataset.name}"
        query = start(rows.writeStream.foreachBatch(load), checkpoint, trigger)
        self.queries[dataset.name] = query
        if query.isActive:
            query.processAllAvailable()
        counts = None if seen_batches else dict.fromkeys(count_names(dataset.rules), 0)
        if not any(name.startswith("batch_id=") for name in scratch.child_names(spark, path)):
            return spark.createDataFrame([], rows.schema), counts
        return read_batches(spark, path, rows.schema).drop("batch_id"), counts

    def _run_changes(self, spark, dataset, frames, folder, trigger):
        path = f"{folder}/{dataset.name}"
        options = dict(dataset.apply)
        scd, except_cols = options.pop("scd"), options.pop("except_cols")
        truncate_when = options.pop("truncate_when")
        feed = self._follow(spark, frames, folder, dataset.inputs[0])
        checkpoint = f"{folder}/_checkpoints/{dataset.name}"
        query = apply_changes(
            feed, path, checkpoint, scd=scd, trigger=trigger, truncate_when=truncate_when, **options
        )
        self.queries[dataset.name] = query
        if query.isActive:
            query.processAllAvailable()
        if not scratch.exists(spark, f"{path}/deltas"):
            nothing = spark.createDataFrame([], feed.schema)
            batch = {1: cdc.scd1, 2: cdc.scd2}[scd]
            return batch(nothing, except_cols=except_cols, **options), None
        read = {1: read_current, 2: read_history}[scd]
        options.pop("delete_when")
        if not query.isActive:
            fold_when_due(spark, path, scd=scd, **options)
        return read(spark, path, except_cols=except_cols, **options), None


@dataclass(frozen=True)
class _Update:
    """One run: its id and the time its log states."""

    id: str
    at: datetime | None

    def entries(self, spark: SparkSession, rows: list[tuple]) -> DataFrame:
        """Log rows of names and counts only, one per dataset, event and batch."""
        at = F.current_timestamp() if self.at is None else F.timestamp_micros(
            F.lit(int(self.at.replace(tzinfo=timezone.utc).timestamp() * 1_000_000))
        )
        return spark.createDataFrame(rows, _LOG).select(
            at.alias("timestamp"),
            "event_type",
            F.struct(F.lit(self.id).alias("update_id"), "flow_name").alias("origin"),
            "details",
        )


def _column_sources(
    dataset: Dataset, frames: Mapping[str, DataFrame], traced: Mapping[str, list] | None
) -> list[dict]:
    """An entry per column and source of it; the source is None where none is known."""
    inputs = {name: set(frames[name].columns) for name in dataset.inputs}
    found = []
    for column in frames[dataset.name].columns:
        sources = dataset.columns.get(column)
        if sources is None and traced is not None:
            sources = traced.get(column)
        if sources is None:  # change flows pass their feed's columns on
            sources = [f"{name}.{column}" for name, columns in inputs.items() if column in columns]
        found += [{"name": column, "source": source} for source in sources or [None]]
    return found


def _log_rows(
    dataset: Dataset,
    frames: Mapping[str, DataFrame],
    counts: Mapping | None,
    traced: Mapping[str, list] | None,
) -> list[tuple]:
    definition = {
        "output_dataset": dataset.name,
        "input_datasets": list(dataset.inputs),
        "flow_type": dataset.kind,
        "comment": dataset.comment,
        "properties": dict(dataset.properties),
        "schema": _column_sources(dataset, frames, traced),
    }
    rows = [(eventlog.DEFINITION, dataset.name, json.dumps({eventlog.DEFINITION: definition}))]
    return rows if counts is None else [*rows, _progress_row(dataset, counts)]


def _progress_row(dataset: Dataset, counts: Mapping, batch_id: int | None = None) -> tuple:
    expectations = [
        {
            "name": rule.name,
            "dataset": dataset.name,
            "passed_records": counts["input_records"] - counts[f"failed_{i}"],
            "failed_records": counts[f"failed_{i}"],
        }
        for i, rule in enumerate(dataset.rules)
    ]
    quality = {"dropped_records": counts["input_records"] - counts["output_records"]}
    if expectations:
        quality["expectations"] = expectations
    metrics = {"num_output_rows": counts["output_records"]}
    if batch_id is not None:
        metrics["batch_id"] = batch_id
    progress = {"status": "RUNNING", "metrics": metrics, "data_quality": quality}
    return eventlog.PROGRESS, dataset.name, json.dumps({eventlog.PROGRESS: progress})


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """The event log of all runs on a folder, with the batches of streams that still run."""
    events = spark.read.parquet(f"{folder}/{_EVENTS}")
    batches = f"{folder}/{_BATCH_EVENTS}"
    if scratch.exists(spark, batches):
        logged = spark.read.option("basePath", batches).parquet(f"{batches}/flow=*/batch_id=*")
        events = events.unionByName(logged.select(*events.columns))
    return events
