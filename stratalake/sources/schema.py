"""JSON-schema documents as Spark schemas. Runs on the driver, once per entity."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import types as T

from stratalake.functions.contract import HARMONISED_COLUMNS, STANDARDISED_COLUMNS

# JSON-schema type names and their Spark types.
SPARK_TYPES = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
    "null": T.NullType(),
    "date-time": T.TimestampType(),
    "timestamp": T.TimestampType(),
}


def to_spark_schema(document: Mapping) -> T.StructType:
    """Struct for the properties of a document; references are followed, empty properties are left out."""
    return _struct(document, document.get("$defs", {}))


def _struct(node: Mapping, defs: Mapping) -> T.StructType:
    out = T.StructType()
    for name, prop in node["properties"].items():
        if prop:
            declared = _follow(prop, defs).get("type")
            out = out.add(name, _type(prop, defs), isinstance(declared, list) and "null" in declared)
    return out


def _follow(node: Mapping, defs: Mapping) -> Mapping:
    while "$ref" in node:
        root, section, name = node["$ref"].split("/")
        if (root, section) != ("#", "$defs"):
            raise ValueError(f"cannot follow reference {node['$ref']!r}")
        node = defs[name]
    return node


def _type(node: Mapping, defs: Mapping) -> T.DataType:
    node = _follow(node, defs)
    declared = node.get("type")
    kind = declared[0] if isinstance(declared, list) else declared
    if kind == "array":
        return T.ArrayType(_type(node["items"], defs))
    if kind == "object":
        return _struct(node, defs)
    if kind not in SPARK_TYPES:
        raise ValueError(f"unsupported type {kind!r} in {dict(node)}")
    return SPARK_TYPES[kind]


def to_flat_schema(document: Mapping, layer: str | None = None, incremental_key: str | None = None) -> dict:
    """Flat schema document: the first of several types counts, a missing type is text, whole numbers are long."""
    fields = []
    for name, prop in document["properties"].items():
        declared = prop.get("type", "string")
        kind = declared[0] if isinstance(declared, list) else declared
        fields.append(
            _field(name, "long" if kind == "integer" else kind, "type" not in prop or "null" in prop["type"])
        )
    if layer == "standardised":
        fields += [_field(n, t, False) for n, t in STANDARDISED_COLUMNS if n != "input_file"]
    if layer == "harmonised":
        if incremental_key:
            fields.insert(0, _field(incremental_key, "string", False))
        names = [("Migrated" if n == "migrated" else n, t) for n, t in HARMONISED_COLUMNS]
        fields += [_field(n, t, i > 0) for i, (n, t) in enumerate(names)]
    return {"fields": fields}


def _field(name: str, kind: str, nullable: bool) -> dict:
    return {"metadata": {}, "name": name, "type": kind, "nullable": nullable}


def add_layer_columns(
    schema: T.StructType, layer: str | None, incremental_key: str | None = None
) -> T.StructType:
    """Entity schema with the columns of its layer; the incremental key of a harmonised table comes first."""
    fields = list(schema.fields)
    if layer == "standardised":
        fields += [_typed(n, t, False) for n, t in STANDARDISED_COLUMNS]
    elif layer == "harmonised":
        if incremental_key:
            fields.insert(0, T.StructField(incremental_key, T.LongType(), False))
        fields += [_typed(n, t, i > 0) for i, (n, t) in enumerate(HARMONISED_COLUMNS)]
    return T.StructType(fields)


def _typed(name: str, kind: str, nullable: bool) -> T.StructField:
    return T.StructField(name, T.TimestampType() if kind == "timestamp" else T.StringType(), nullable)


def load_document(text: str) -> dict:
    return json.loads(text)
