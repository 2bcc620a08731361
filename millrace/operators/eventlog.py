"""Event-log rows (semi-structured) and the monitoring queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The event kinds, also the names of their detail objects.
PROGRESS, DEFINITION, UPDATE = "flow_progress", "flow_definition", "create_update"


def _row(ts: Column, kind: str, update_id: Column, flow_name: Column, details: Column) -> list[Column]:
    return [
        ts.alias("timestamp"),
        F.lit(kind).alias("event_type"),
        F.struct(update_id.alias("update_id"), flow_name.alias("flow_name")).alias("origin"),
        F.to_json(details).alias("details"),
    ]


def progress_rows(
    df: DataFrame,
    *,
    ts: Column,
    update_id: Column,
    flow_name: Column,
    output: Column,
    dropped: Column,
    expectations: Column,
    status: Column | None = None,
) -> DataFrame:
    """flow_progress rows; ``expectations`` is an array of (name, dataset, passed, failed)."""
    details = F.struct(
        F.struct(
            (F.lit("RUNNING") if status is None else status).alias("status"),
            F.struct(output.alias("num_output_rows")).alias("metrics"),
            F.struct(dropped.alias("dropped_records"), expectations.alias("expectations")).alias(
                "data_quality"
            ),
        ).alias(PROGRESS)
    )
    return df.select(*_row(ts, PROGRESS, update_id, flow_name, details))


def update_rows(df: DataFrame, *, ts: Column, update_id: Column) -> DataFrame:
    details = F.struct(F.struct(update_id.alias("update_id")).alias(UPDATE))
    return df.select(*_row(ts, UPDATE, update_id, F.lit(None).cast("string"), details))


def _at(path: str, kind: str) -> Column:
    return F.variant_get("__details", f"$.{path}", kind)


def _parsed(log: DataFrame, kind: str) -> DataFrame:
    return log.where(F.col("event_type") == kind).withColumn("__details", F.parse_json("details"))


def definitions(log: DataFrame) -> DataFrame:
    """Each flow's output, inputs and type, in time order."""
    root = f"{DEFINITION}"
    return (
        _parsed(log, DEFINITION)
        .select(
            "timestamp",
            _at(f"{root}.output_dataset", "string").alias("output_dataset"),
            _at(f"{root}.input_datasets", "array<string>").alias("input_datasets"),
            _at(f"{root}.flow_type", "string").alias("flow_type"),
            _at(f"{root}.schema", "array<struct<name string, source string>>").alias("schema"),
        )
        .orderBy("timestamp", "output_dataset")
    )


def table_lineage(log: DataFrame) -> DataFrame:
    """(source_table, target_table) edges stated by the definitions."""
    return (
        definitions(log)
        .select(
            F.explode("input_datasets").alias("source_table"),
            F.col("output_dataset").alias("target_table"),
        )
        .distinct()
    )


def column_lineage(log: DataFrame) -> DataFrame:
    """(source_table, source_column, target_table, target_column) edges."""
    return (
        definitions(log)
        .select("output_dataset", F.explode("schema").alias("column"))
        .where("column.source IS NOT NULL")
        .select(
            F.regexp_extract("column.source", r"^(.*)\.[^.]+$", 1).alias("source_table"),
            F.split_part("column.source", F.lit("."), F.lit(-1)).alias("source_column"),
            F.col("output_dataset").alias("target_table"),
            F.col("column.name").alias("target_column"),
        )
        .distinct()
    )


def expectation_rows(log: DataFrame) -> DataFrame:
    """One row per rule and update, exploded from the progress events' variant array."""
    running = _parsed(log, PROGRESS).where(_at(f"{PROGRESS}.status", "string") == "RUNNING")
    listed = running.withColumn(
        "__list", F.variant_get("__details", f"$.{PROGRESS}.data_quality.expectations", "variant")
    ).where("__list IS NOT NULL")
    exploded = listed.lateralJoin(
        log.sparkSession.tvf.variant_explode(F.col("__list").outer())
    )
    field = lambda name, kind: F.variant_get("value", f"$.{name}", kind)
    return exploded.select(
        F.col("timestamp"),
        F.col("origin.update_id").alias("update_id"),
        field("name", "string").alias("name"),
        field("dataset", "string").alias("dataset"),
        field("passed_records", "bigint").alias("passed_records"),
        field("failed_records", "bigint").alias("failed_records"),
    )


def flow_progress(log: DataFrame) -> DataFrame:
    """Typed progress figures of the running flows."""
    rows = _at(f"{PROGRESS}.metrics.num_output_rows", "bigint")
    return (
        _parsed(log, PROGRESS)
        .where((_at(f"{PROGRESS}.status", "string") == "RUNNING") & rows.isNotNull())
        .select(
            F.col("timestamp").cast("date").alias("date"),
            F.split_part("origin.flow_name", F.lit("."), F.lit(-1)).alias("table_name"),
            rows.alias("output_records"),
            _at(f"{PROGRESS}.data_quality.dropped_records", "bigint").alias("dropped_records"),
        )
    )


def quality_by(log: DataFrame, *keys: str) -> DataFrame:
    """Records kept and dropped with their ratio, by any of ``date`` and ``table_name``."""
    return (
        flow_progress(log)
        .groupBy(*keys)
        .agg(
            F.sum("output_records").alias("output_records"),
            F.sum("dropped_records").alias("dropped_records"),
        )
        .withColumn(
            "failure_rate",
            F.try_divide(F.col("dropped_records").cast("double"), F.col("output_records")),
        )
    )


def latest_update_day(log: DataFrame) -> Column:
    """Day of the newest update, as a scalar subquery."""
    return (
        log.where(F.col("event_type") == UPDATE)
        .agg(F.max(F.col("timestamp").cast("date")).alias("d"))
        .scalar()
    )


def latest_only(log: DataFrame) -> DataFrame:
    return log.where(F.col("timestamp").cast("date") == latest_update_day(log))
