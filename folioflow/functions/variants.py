"""Helpers for payloads whose shape is only known per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_OBJECT = "map<string,variant>"
_LIST = "array<variant>"


def parse(text: Column) -> Column:
    """Null where the text is no JSON."""
    return F.try_parse_json(text)


def is_readable(text: Column) -> Column:
    """JSON other than a bare null. The null test of a variant says false for no variant at all."""
    v = parse(text)
    return v.isNotNull() & ~F.is_variant_null(v)


def as_list(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, _LIST)


def as_object(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, _OBJECT)


def text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def number(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "double")


def whole(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "bigint")


def has_key(v: Column, key: str) -> Column:
    """True for an object that carries the key, even with a null under it."""
    return F.try_variant_get(v, f"$.{key}", "variant").isNotNull()


def is_object(v: Column) -> Column:
    return as_object(v).isNotNull()


def objects_of(values: Column) -> Column:
    """Keep the objects of a list, in order."""
    return F.filter(values, is_object)


def kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def text_only(v: Column, path: str) -> Column:
    """The value if it is a JSON string, else null."""
    quoted = F.to_json(F.try_variant_get(v, path, "variant")).startswith('"')
    return F.when(quoted, text(v, path))


def usable_text(v: Column, path: str) -> Column:
    """The value as text, or null where it is empty, zero, false or absent."""
    shown = text(v, path)
    # The type is only looked at where the text could stand for a zero.
    zero = shown.isin("", "0", "0.0", "false") & ((shown == "") | (kind(v, path) != "STRING"))
    return F.when(~zero, shown)
