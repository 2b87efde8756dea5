"""Landed JSON: typed parsing and shape tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_object(payload: Column, schema: str) -> Column:
    """JSON object to struct. Absent fields, other JSON kinds and broken JSON give null fields.

    Scalars are declared STRING in the payload schemas and cast afterwards, so that ``12`` and
    ``"12"`` read alike and one bad field does not null its neighbours.
    """
    return F.from_json(payload, schema, {"mode": "PERMISSIVE"})


def json_kind(payload: Column) -> Column:
    """``object``, ``array``, ``scalar``, or ``invalid`` for text that is not JSON."""
    kind = F.schema_of_variant(F.try_parse_json(payload))
    return (
        F.when(payload.isNull(), F.lit("missing"))
        .when(kind.isNull(), "invalid")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("scalar")
    )


def is_broken(payload: Column) -> Column:
    """Text that is not JSON: :func:`json_kind` is ``invalid``, told without the type of all that is valid."""
    return payload.isNotNull() & F.try_parse_json(payload).isNull()


def json_elements(body: Column) -> Column:
    """The elements of a JSON array as variants; null for another kind."""
    return F.from_json(body, "array<variant>")


def is_object(element: Column) -> Column:
    return F.schema_of_variant(element).startswith("OBJECT")


def is_text(element: Column) -> Column:
    return F.schema_of_variant(element) == "STRING"


def is_whole_number(element: Column) -> Column:
    return F.schema_of_variant(element) == "BIGINT"
