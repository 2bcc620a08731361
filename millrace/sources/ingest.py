"""Incremental file ingestion: every file once, across restarts, into batch-addressed folders."""

from __future__ import annotations

import csv
import functools

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.json import infer_json_schema, merged_schema, struct_of
from millrace.sources import evolution
from millrace.sources.evolution import NewColumns, SchemaStore
from millrace.sources.files import infer_schema, with_hints
from millrace.streaming.flows import (
    is_published,
    publish_batch,
    read_batches,
    staging_folder,
    start,
    write_batch,
)

SOURCE_FILE, LOAD_TIME = "_source_file", "_load_time"
# The columns of Spark's source of whole files; only the path is read here.
_LISTED = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def _file_stream(spark, src, fmt, schema, max_files, options) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(src).select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.current_timestamp().alias(LOAD_TIME),
    )


def ingest_json(
    spark: SparkSession,
    src: str,
    target: str,
    checkpoint: str,
    *,
    mode: str = evolution.ADD,
    hints: str | None = None,
    trigger: str = "availableNow",
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Stream JSON-lines files into ``target``, evolving the stored schema by ``mode``.

    The schema is inferred from the first batch, stored beside the checkpoint and reused. Each
    batch is written with the stored schema while the same pass observes the schema of what it
    read; only a batch that really brings new columns is staged again, widened. Its folder is
    published when it is final and never changes then, so neither a replay nor a widening gives a
    stream that reads the target a row twice. Blank lines are skipped.
    """
    store = SchemaStore(spark, checkpoint)
    lines = _file_stream(spark, src, "text", None, max_files, options)
    lines = lines.where(F.trim("value") != "")

    def first_schema(batch: DataFrame) -> T.StructType:
        inferred = infer_json_schema(batch, "value")
        return with_hints(inferred, hints) if hints else inferred

    def write(batch: DataFrame, batch_id: int, schema: T.StructType) -> None:
        rows = evolution.parse_records(batch, schema, mode, keep=(SOURCE_FILE, LOAD_TIME))
        rows.write.mode("overwrite").parquet(staging_folder(target, batch_id))

    def load(batch: DataFrame, batch_id: int) -> None:
        if not is_published(spark, target, batch_id):
            stage(batch, batch_id)
            publish_batch(spark, target, batch_id)

    def stage(batch: DataFrame, batch_id: int) -> None:
        stored = store.load()
        if stored is None:
            stored = first_schema(batch)
            store.save(stored)
        if mode == evolution.FAIL:
            added = evolution.new_columns(stored, infer_json_schema(batch, "value"))
            if added:
                raise NewColumns(f"new columns {added} in batch {batch_id}")
        if mode != evolution.ADD:
            write(batch, batch_id, stored)
            return
        seen = Observation()
        found = merged_schema("value").alias("schema")
        write(batch.observe(seen, found), batch_id, stored)
        widened = evolution.widen(stored, struct_of(seen.get["schema"] or "VOID"))
        if widened != stored:
            store.save(widened)
            write(batch, batch_id, widened)

    return start(lines.writeStream.foreachBatch(load), checkpoint, trigger)


def _file_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """First line of each file, with the files that have it; files without one are left out."""
    lines = spark.read.text(paths).where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    placed = lines.select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("place")
    )
    first = placed.groupBy("path").agg(F.min_by("value", "place").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("path").collect():
        found.setdefault(row["header"], []).append(row["path"])
    return found


def _header_names(header: str, sep: str) -> list[str]:
    """Names of the cells; a cell without a name of its own is called by its place."""
    names: list[str] = []
    for place, cell in enumerate(next(csv.reader([header.lstrip("\ufeff")], delimiter=sep))):
        name = cell.strip() or f"_c{place}"
        taken = name.lower() in {n.lower() for n in names}
        names.append(f"{name}_c{place}" if taken else name)
    return names


def ingest_csv(
    spark: SparkSession,
    src: str,
    target: str,
    checkpoint: str,
    *,
    mode: str = evolution.ADD,
    hints: str | None = None,
    trigger: str = "availableNow",
    max_files: int = 1000,
    sep: str = ",",
    **options,
) -> StreamingQuery:
    """Stream delimited files with a header line into ``target``, evolving the stored schema by ``mode``.

    Every file is read by its own header, so columns may come in any order, be missing or be new.
    Headers tell new columns before a batch is parsed, so a batch is staged once; only the types of
    new columns are inferred, from the files that bring them. A cell of the wrong type reads NULL and
    is kept in the rescued column beside unknown columns (there under its name in lower case); a line
    with more or fewer cells than its header keeps the cells it has, and is rescued whole. Names are
    compared without regard to case. The driver holds the names of one batch's files, ``max_files``
    at most.
    """
    store = SchemaStore(spark, checkpoint)
    listed = spark.readStream.format("binaryFile").schema(_LISTED).option("maxFilesPerTrigger", max_files)
    listed = listed.load(src).select("path")

    def infer(paths: list[str]) -> list[T.StructField]:
        read = spark.read.options(header=True, inferSchema=True, sep=sep, **options).csv(paths)
        wide = {T.IntegerType(): T.LongType(), T.NullType(): T.StringType()}
        return [T.StructField(f.name, wide.get(f.dataType, f.dataType)) for f in read.schema.fields]

    def schema_for(headers: dict[str, list[str]], batch_id: int) -> T.StructType:
        stored = store.load()
        if stored is not None and mode != evolution.ADD and mode != evolution.FAIL:
            return stored
        known = {f.name.lower() for f in stored.fields} if stored else set()
        fields = list(stored.fields) if stored else []
        for header, paths in headers.items():
            names = _header_names(header, sep)
            if all(n.lower() in known for n in names):
                continue
            if stored is not None and mode == evolution.FAIL:
                added = [n for n in names if n.lower() not in known]
                raise NewColumns(f"new columns {added} in batch {batch_id}")
            for name, field in zip(names, infer(paths)):
                if name.lower() not in known:
                    known.add(name.lower())
                    fields.append(T.StructField(name, field.dataType))
        schema = T.StructType(fields)
        if stored is None and hints:
            schema = with_hints(schema, hints)
        if schema != stored:
            store.save(schema)
        return schema

    def cells(header: str, paths: list[str]) -> DataFrame:
        names = [n.lower() for n in _header_names(header, sep)]
        inner = [f"c{k}" for k in range(len(names))]
        kinds = T.StructType([T.StructField(n, T.StringType()) for n in [*inner, "broken"]])
        read = spark.read.schema(kinds).options(header=True, sep=sep, columnNameOfCorruptRecord="broken", **options)
        pairs = [part for name, column in zip(names, inner) for part in (F.lit(name), F.col(column))]
        return read.csv(paths).select(
            F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("__fields"),
            F.col("broken").alias("__broken"),
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.current_timestamp().alias(LOAD_TIME),
        )

    def load(batch: DataFrame, batch_id: int) -> None:
        if is_published(spark, target, batch_id):
            return
        headers = _file_headers(spark, [r["path"] for r in batch.collect()])
        if not headers:
            return
        schema = schema_for(headers, batch_id)
        rows = functools.reduce(DataFrame.unionByName, [cells(h, p) for h, p in headers.items()])
        shaped = evolution.shape_records(rows, schema, mode, (SOURCE_FILE, LOAD_TIME), lower_names=True)
        write_batch(shaped, target, batch_id)

    return start(listed.writeStream.foreachBatch(load), checkpoint, trigger)


def ingest_files(
    spark: SparkSession,
    src: str,
    fmt: str,
    target: str,
    checkpoint: str,
    *,
    schema: T.StructType | str | None = None,
    hints: str | None = None,
    trigger: str = "availableNow",
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Stream files of any format into ``target`` with a fixed or stored inferred schema."""
    store = SchemaStore(spark, checkpoint)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    schema = store.load() or schema
    if schema is None:
        schema = infer_schema(spark, src, fmt, **options)
        schema = with_hints(schema, hints) if hints else schema
    store.save(schema)
    rows = _file_stream(spark, src, fmt, schema, max_files, options)

    def load(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, target, batch_id)

    return start(rows.writeStream.foreachBatch(load), checkpoint, trigger)


def read_ingested(
    spark: SparkSession, target: str, checkpoint: str, mode: str = evolution.ADD
) -> DataFrame:
    """The ingested rows under the stored schema; rows from before a new column read NULL."""
    schema = SchemaStore(spark, checkpoint).load()
    extra = [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(LOAD_TIME, T.TimestampType()),
    ]
    if mode != evolution.NONE:
        extra.insert(0, T.StructField(evolution.RESCUED, T.StringType()))
    return read_batches(spark, target, T.StructType(schema.fields + extra)).drop("batch_id")
