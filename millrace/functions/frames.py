"""Rows made in Python as Arrow batches, whose columns are as the schema says, also where all values are missing."""

from __future__ import annotations

import pyarrow as pa

_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}


def arrow_schema(schema: str) -> pa.Schema:
    """Of a schema of plain columns: "name type, ..."."""
    fields = [f.split() for f in schema.replace("\n", " ").split(",")]
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])
