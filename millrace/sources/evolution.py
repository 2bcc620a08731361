"""Stored schemas, their evolution, and the rescued-data column for JSON and delimited records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace import scratch

RESCUED = "_rescued_data"

# What happens when a record brings a field the stored schema lacks.
ADD, RESCUE, FAIL, NONE = "addNewColumns", "rescue", "failOnNewColumns", "none"
MODES = (ADD, RESCUE, FAIL, NONE)


class NewColumns(ValueError):
    """A record brought fields the stored schema lacks."""


class SchemaStore:
    """The inferred schema kept beside a checkpoint, so later runs do not infer again."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._path = f"{folder}/schema.json"

    def load(self) -> T.StructType | None:
        text = scratch.read_text(self._spark, self._path)
        return None if text is None else T._parse_datatype_json_string(text)

    def save(self, schema: T.StructType) -> None:
        scratch.write_text(self._spark, self._path, schema.json())


def widen(stored: T.DataType, seen: T.DataType) -> T.DataType:
    """The stored type with the fields only ``seen`` has appended, at every depth.

    Types already stored never change, and a field that differs only in case is not new: values
    that do not fit are rescued.
    """
    if isinstance(stored, T.StructType) and isinstance(seen, T.StructType):
        found = {f.name.lower(): f for f in seen.fields}
        fields = []
        for f in stored.fields:
            match = found.pop(f.name.lower(), None)
            kind = widen(f.dataType, match.dataType) if match else f.dataType
            fields.append(T.StructField(f.name, kind, f.nullable, f.metadata))
        return T.StructType(fields + list(found.values()))
    if isinstance(stored, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(widen(stored.elementType, seen.elementType))
    return stored


def new_columns(stored: T.StructType, seen: T.StructType) -> list[str]:
    """Top-level columns that widening adds or changes."""
    before = {f.name: f.dataType for f in stored.fields}
    return [f.name for f in widen(stored, seen).fields if before.get(f.name) != f.dataType]


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _typed(raw: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return raw
    return F.from_json(raw, kind) if isinstance(kind, _NESTED) else raw.try_cast(kind)


def _fits(raw: Column, kind: T.DataType) -> Column:
    """TRUE when the JSON text ``raw`` converts to ``kind`` without losing anything inside."""
    if isinstance(kind, T.StringType):
        return F.lit(True)
    if isinstance(kind, T.StructType):
        parts = F.from_json(raw, "map<string,string>")
        names = F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>")
        fits = parts.isNotNull() & (F.size(F.array_except(F.map_keys(parts), names)) == 0)
        for f in kind.fields:
            value = parts.getItem(f.name)
            fits = fits & (value.isNull() | _fits(value, f.dataType))
        return F.coalesce(fits, F.lit(False))
    if isinstance(kind, T.ArrayType):
        parts = F.from_json(raw, "array<string>")
        element = lambda x: x.isNull() | _fits(x, kind.elementType)
        return F.coalesce(F.forall(parts, element), F.lit(False))
    return _typed(raw, kind).isNotNull()


def parse_records(
    lines: DataFrame, schema: T.StructType, mode: str, value: str = "value", keep: tuple = ()
) -> DataFrame:
    """Parse JSON text lines to ``schema``; every other column named in ``keep`` stays.

    Each line is parsed once to a map of its top-level fields. A field of the wrong type reads
    NULL. Except in mode none, what did not fit (wrong types, unknown fields at any depth, broken
    lines) is kept as one JSON object of the top-level fields concerned in the rescued column.
    """
    fields = F.from_json(value, "map<string,string>")
    parsed = lines.withColumn("__fields", fields).withColumn(
        "__broken", F.when(F.col("__fields").isNull(), F.col(value))
    )
    return shape_records(parsed, schema, mode, keep)


def shape_records(
    parsed: DataFrame, schema: T.StructType, mode: str, keep: tuple = (), lower_names: bool = False
) -> DataFrame:
    """Typed columns out of ``__fields`` (name to text); ``__broken`` holds a line that did not parse.

    ``lower_names`` tells that the map's names are in lower case, whatever the schema's are.
    """
    if mode not in MODES:
        raise ValueError(f"unknown evolution mode {mode!r}; choose one of {MODES}")
    named = {f.name: f.name.lower() if lower_names else f.name for f in schema.fields}
    raw = {f.name: F.col("__fields").getItem(named[f.name]) for f in schema.fields}
    columns = [_typed(raw[f.name], f.dataType).alias(f.name) for f in schema.fields]
    if mode != NONE:
        misfit = [
            F.when(raw[f.name].isNotNull() & ~_fits(raw[f.name], f.dataType), named[f.name])
            for f in schema.fields
            if not isinstance(f.dataType, T.StringType)
        ]
        bad = F.array_compact(F.array(F.lit(None).cast("string"), *misfit))
        known = F.array(*[F.lit(name) for name in named.values()]).cast("array<string>")
        rest = F.map_filter(
            "__fields", lambda k, v: ~F.array_contains(known, k) | F.array_contains(bad, k)
        )
        broken = F.to_json(F.create_map(F.lit("_corrupt_record"), F.col("__broken")))
        rescued = F.when(F.col("__broken").isNotNull(), broken).when(
            F.size(rest) > 0, F.to_json(rest)
        )
        columns.append(rescued.alias(RESCUED))
    return parsed.select(*columns, *keep)
