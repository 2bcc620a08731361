"""Starting streams and writing micro-batches to folders addressed by batch id."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace import scratch


def trigger_options(trigger: str) -> dict:
    """Trigger arguments for ``availableNow``, ``once`` or an interval such as ``30 seconds``.

    ``once`` is the deprecated form of ``availableNow`` and is served by it. File sources have no
    continuous mode, so ``continuous 1 second`` becomes a one-second interval.
    """
    if trigger in ("availableNow", "once"):
        return {"availableNow": True}
    return {"processingTime": trigger.removeprefix("continuous ").strip()}


def start(
    writer: DataStreamWriter, checkpoint: str, trigger: str, wait: bool = True
) -> StreamingQuery:
    """Start a stream; an ``availableNow`` one is awaited, so its output is complete."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger)).start()
    )
    if wait and trigger in ("availableNow", "once"):
        query.awaitTermination()
    return query


def batch_folder(target: str, batch_id: int) -> str:
    return f"{target}/batch_id={batch_id}"


def staging_folder(target: str, batch_id: int) -> str:
    """Where a batch is written before it is published; readers skip names with an underscore."""
    return f"{target}/_staging/{batch_id}"


def is_published(spark: SparkSession, target: str, batch_id: int) -> bool:
    return scratch.exists(spark, batch_folder(target, batch_id))


def publish_batch(spark: SparkSession, target: str, batch_id: int) -> None:
    """Make a staged batch visible, by one rename and for good.

    A published folder never changes, so a stream that reads the target meets every file once,
    also when the batch is replayed after a failure.
    """
    scratch.publish(spark, staging_folder(target, batch_id), batch_folder(target, batch_id))


def write_batch(rows: DataFrame, target: str, batch_id: int) -> None:
    """Stage and publish one batch; nothing happens where it is published already."""
    spark = rows.sparkSession
    if is_published(spark, target, batch_id):
        return
    rows.write.mode("overwrite").parquet(staging_folder(target, batch_id))
    publish_batch(spark, target, batch_id)


def read_batches(
    spark: SparkSession, target: str, schema: T.StructType | None = None
) -> DataFrame:
    """All batches of a batch-addressed target, with their ``batch_id``."""
    reader = spark.read.option("basePath", target)
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())]))
    return reader.parquet(f"{target}/batch_id=*")


def append_flow(
    rows: DataFrame, target: str, checkpoint: str, trigger: str = "availableNow"
) -> StreamingQuery:
    """Append a stateless stream to Parquet through the file sink and its commit log."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", target)
    return start(writer, checkpoint, trigger)


def batch_flow(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    trigger: str = "availableNow",
    shape: Callable[[DataFrame], DataFrame] | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Write every micro-batch, after ``shape``, to its own folder.

    The folder is published once, so replaying a batch after a failure is harmless, also for
    streams that read the target. The checkpoint and the target belong together: a new checkpoint
    needs a new target.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch if shape is None else shape(batch), target, batch_id)

    return start(rows.writeStream.foreachBatch(write), checkpoint, trigger, wait)


def multi_flow(
    flows: Mapping[str, DataFrame], target: str, checkpoint: str, trigger: str = "availableNow"
) -> list[StreamingQuery]:
    """Append several streams to one target, side by side.

    Each flow has its own checkpoint and folder, so they neither wait for nor overwrite another.
    """
    queries = [
        batch_flow(rows, f"{target}/flow={name}", f"{checkpoint}/{name}", trigger, wait=False)
        for name, rows in flows.items()
    ]
    if trigger in ("availableNow", "once"):
        for query in queries:
            query.awaitTermination()
    return queries


def read_flows(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all flows of a ``multi_flow`` target."""
    return (
        spark.read.option("basePath", target)
        .parquet(f"{target}/flow=*/batch_id=*")
        .drop("batch_id")
    )
