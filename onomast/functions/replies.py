"""Typed values out of JSON replies, with defaults for all that can go wrong."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false"}


def _object(c: Column, schema: str) -> Column:
    """The parsed object; null for an array, a bare value, broken JSON or no reply."""
    return F.from_json(F.when(c.rlike(r"^\s*\{"), c), schema, _STRICT)


def _keys(c: Column) -> Column:
    """The object's keys; null for anything but a whole JSON object."""
    return F.when(c.rlike(r"^\s*\{"), F.json_object_keys(c))


def json_default(c: Column, field: str, default: str) -> Column:
    """One text field of a JSON object, or the default."""
    return F.coalesce(_object(c, f"`{field}` string")[field], F.lit(default))


def json_all_or_nothing(c: Column, required: str, defaults: dict[str, str], missing: dict[str, str]) -> Column:
    """Several text fields of a JSON object as a struct.

    A field that is absent takes its value from ``missing``. If the reply cannot be read, or ``required`` is there
    but null or no text, all fields take their value from ``defaults`` and the field ``ok`` is false.
    """
    parsed = _object(c, ", ".join(f"`{f}` string" for f in defaults))
    keys = _keys(c)
    # Read as a map of raw JSON values, a text is the one kind that stands in quotes.
    kind = F.schema_of_variant(_object(c, f"`{required}` variant")[required])
    usable = keys.isNotNull() & parsed.isNotNull() & (
        (parsed[required].isNotNull() & F.coalesce(kind == "STRING", F.lit(False))) | ~F.array_contains(keys, required)
    )
    fields = [
        F.when(usable, F.coalesce(parsed[f], F.lit(missing[f]))).otherwise(F.lit(default)).alias(f)
        for f, default in defaults.items()
    ]
    return F.struct(*fields, F.coalesce(usable, F.lit(False)).alias("ok"))
