"""Reading JSON whose shape can't be trusted: VARIANT values, taken apart element by element.

A broken element costs only itself: what isn't of the expected kind is null here, and the caller says what null means.
Texts that are no JSON, have something behind the JSON value, or repeat a key within an object are null as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number as text: digits, maybe with a point and an exponent; no suffixes, no words.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parsed(text: Column) -> Column:
    """The one JSON value that the text holds; null for anything else."""
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(one) == 1, one[0])


def items(value: Column) -> Column:
    """The elements of a list; null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def field(value: Column, name: str) -> Column:
    """An object's field; null where it is missing or there is no object. A JSON null is a value."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def is_list(value: Column) -> Column:
    return items(value).isNotNull()


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_string(value: Column) -> Column:
    return F.coalesce(_kind(value) == "STRING", F.lit(False))


def number(value: Column) -> Column:
    """A number, a number in a text, or a truth value as 0 or 1; null for anything else."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(is_string(value), F.when(text.rlike(NUMBER), text.try_cast("double"))).otherwise(F.try_variant_get(value, "$", "double"))


def text(value: Column) -> Column:
    """A text as it is, True, False or None for these, a number's digits, JSON for lists and objects; null where there is no value."""
    plain = F.try_variant_get(value, "$", "string")
    kind = _kind(value)
    return F.when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(plain)).otherwise(plain)


def empty(value: Column) -> Column:
    """Whether there is no value, or null, false, 0, an empty text, list or object."""
    nothing = F.when(is_string(value), F.try_variant_get(value, "$", "string") == "").otherwise(F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False)))
    size = F.coalesce(F.size(items(value)), F.size(F.try_variant_get(value, "$", "map<string,variant>")))
    return value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False)) | F.coalesce(F.when(size >= 0, size == 0), nothing)
