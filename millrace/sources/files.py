"""One reader for every file format, with explicit, inferred or hinted schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Avro needs the spark-avro package on the cluster; the others are built in.
FORMATS = ("parquet", "json", "csv", "orc", "text", "binaryFile", "avro")


def with_hints(schema: T.StructType, hints: str) -> T.StructType:
    """Replace the types of the hinted columns (``"a INT, b DATE"``), add the missing ones."""
    hinted = {f.name: f for f in T.StructType.fromDDL(hints).fields}
    fields = [hinted.pop(f.name, f) for f in schema.fields]
    return T.StructType(fields + list(hinted.values()))


def infer_schema(spark: SparkSession, path: str, fmt: str, **options) -> T.StructType:
    """Schema found by the format's own inference; ``samplingRatio`` bounds what JSON/CSV read."""
    if fmt == "csv":
        options.setdefault("inferSchema", True)
    return spark.read.format(fmt).options(**options).load(path).schema


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    *,
    schema: T.StructType | str | None = None,
    hints: str | None = None,
    **options,
) -> DataFrame:
    """Read files of any supported format; ``path`` may be a glob or a list.

    A given schema spares the inference pass over the text formats.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; choose one of {FORMATS}")
    if hints is not None:
        if schema is None:
            schema = infer_schema(spark, path, fmt, **options)
        elif isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = with_hints(schema, hints)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", options.get("inferSchema", True))
    return reader.load(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    sep: str = ",",
    header: bool = True,
    multiline: bool = False,
    **options,
) -> DataFrame:
    """CSV with quotes doubled inside quoted fields.

    ``multiline`` lets quoted fields span lines; such files cannot be split, so keep them small.
    """
    return read_files(
        spark,
        path,
        "csv",
        schema=schema,
        sep=sep,
        header=header,
        multiLine=multiline,
        quote='"',
        escape='"',
        **options,
    )


def file_columns() -> list[Column]:
    """Audit columns of the file a row came from."""
    return [
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_name").alias("_file_name"),
        F.col("_metadata.file_size").alias("_file_size"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.current_timestamp().alias("_load_time"),
    ]


def list_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """(path, modificationTime, length) of every file below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .options(**options)
        .load(path)
        .select("path", "modificationTime", "length")
    )
