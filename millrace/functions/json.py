"""JSON helpers built on variants and native parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

_QUOTED_NAME = re.compile(r"(`(?:[^`]|``)*`)")
_TYPES = (
    (re.compile(r"\bOBJECT<"), "STRUCT<"),
    (re.compile(r"\bDECIMAL\(\d+,\s*\d+\)"), "DOUBLE"),
    (re.compile(r"\b(VOID|VARIANT)\b(?!:)"), "STRING"),
)


def struct_of(variant_type: str) -> T.StructType:
    """The struct named by ``schema_of_variant``'s text form, with plain Spark field types.

    Fractional numbers become DOUBLE, as file readers infer them; fields that were only ever
    NULL, or of clashing types, are kept as STRING. Of names that differ only in case the first
    stays, since Spark could not tell the columns apart.
    """
    parts = _QUOTED_NAME.split(variant_type)
    for i in range(0, len(parts), 2):
        for pattern, replacement in _TYPES:
            parts[i] = pattern.sub(replacement, parts[i])
    parsed = T._parse_datatype_string("".join(parts))
    if not isinstance(parsed, T.StructType):
        return T.StructType([])
    fields = {}
    for field in parsed.fields:
        fields.setdefault(field.name.lower(), field)
    return T.StructType(list(fields.values()))


def merged_schema(column: str) -> Column:
    """Aggregate: the common schema of every JSON object in a text column, in text form.

    Lines that are broken or hold something else than an object have no say in it.
    """
    is_object = F.col(column).rlike(r"^\s*\{")
    return F.schema_of_variant_agg(F.when(is_object, F.try_parse_json(column)))


def infer_json_schema(df: DataFrame, column: str) -> T.StructType:
    """Merged schema of every document in a JSON text column: one distributed aggregation."""
    return struct_of(df.agg(merged_schema(column)).first()[0] or "VOID")
