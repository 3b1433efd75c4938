"""Shape and content checks of JSON texts."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _walk(value, depth=1):
    """Every node of a JSON value with its depth and, for members, its key."""
    stack = [(value, depth, None)]
    while stack:
        node, level, key = stack.pop()
        yield node, level, key
        if isinstance(node, dict):
            stack.extend((v, level + 1, k) for k, v in node.items())
        elif isinstance(node, list):
            stack.extend((v, level + 1, None) for v in node)


def json_shape(column: Column) -> Column:
    """struct(depth, nodes) of a JSON text; null if it is null or no JSON."""

    def shape(text: str | None) -> dict | None:
        try:
            seen = [level for _, level, _ in _walk(json.loads(text))] if text is not None else None
        except (ValueError, RecursionError):
            return None
        return seen and {"depth": max(seen), "nodes": len(seen)}

    arrow = pa.struct([("depth", pa.int32()), ("nodes", pa.int32())])
    return F.arrow_udf(lambda v: pa.array([shape(t) for t in v.to_pylist()], arrow), "struct<depth:int,nodes:int>")(column)


def has_key(column: Column, *keys: str) -> Column:
    """Whether any of the keys occurs at any depth; null if the text is null or no JSON."""
    wanted = set(keys)

    def found(text: str | None) -> bool | None:
        try:
            return None if text is None else any(key in wanted for _, _, key in _walk(json.loads(text)))
        except (ValueError, RecursionError):
            return None

    return F.arrow_udf(lambda v: pa.array([found(t) for t in v.to_pylist()], pa.bool_()), "boolean")(column)


def json_type(column: Column, path: str) -> Column:
    """Type of a value in a JSON text: ``boolean``, ``number``, ``string``, ``array``, ``object``, ``null``, or null if absent."""
    value = F.try_variant_get(F.try_parse_json(column), path, "variant")
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), None).when(kind == "VOID", "null").when(kind == "BOOLEAN", "boolean").when(kind == "STRING", "string")
        .when(F.startswith(kind, F.lit("ARRAY")), "array").when(F.startswith(kind, F.lit("OBJECT")), "object").otherwise("number")
    )
