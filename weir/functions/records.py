"""Schema-less JSON records as Column expressions.

A record is a VARIANT while it travels (one compact value per row) and a
MAP<STRING, VARIANT> while keys are added or removed, so unknown keys survive.
Nothing here raises on bad data: every function gives NULL instead.

Numbers keep the characters they came with. A VARIANT or a JSON reader would write ``100.00`` or ``1e3`` its own
way, so :func:`marked` turns the numbers of a text that has such ones into marked texts before anything is parsed, and
:func:`unmarked` takes the marks off when text is written. The mark is U+FFFF, which no text may hold;
messages that hold it are not accepted as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
TEXT_OBJECT = "map<string,string>"
OBJECTS = "array<map<string,variant>>"


MARK = "\uffff"

# A whole JSON string, quotes included.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'

_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"

# From the end of the match before: what is neither string nor number, then a number that ends like one.
_NEXT_NUMBER = rf'\G((?:[^"0-9-]++|{_STRING})*+)({_NUMBER})(?=[\s,}}\]]|$)'


# What a text holds if some number in it may be written in another way by a reader: a fraction, an exponent, a minus zero,
# more digits than a BIGINT surely has.
# Looked for where a run of digits begins only.
_UNSETTLED = "(?<![0-9])[0-9](?:[0-9]{17}|[0-9]*+[.eE])|-0"


def marked(text: Column | str) -> Column:
    """JSON text with its numbers as marked strings, where any of them needs it. Text that is not JSON does not become JSON by it."""
    text = F.col(text) if isinstance(text, str) else text
    holds_mark = text.contains(MARK) | (text.contains("\\u") & text.rlike("\\\\u[fF]{4}"))
    numbers = F.when(text.rlike(_UNSETTLED), F.regexp_replace(text, _NEXT_NUMBER, f'$1"{MARK}$2"')).otherwise(text)
    return F.when(~holds_mark, numbers)


def unmarked(text: Column | str) -> Column:
    """JSON text with numbers as they came."""
    return F.regexp_replace(text, f'"{MARK}([^"]*)"', "$1")


def parse(text: Column | str) -> Column:
    """JSON text to VARIANT, numbers marked; NULL when it is not JSON."""
    return F.try_parse_json(marked(text))


def plain(value: Column) -> Column:
    """A scalar read as text, without the mark of a number; objects and arrays as JSON text."""
    return F.when(value.startswith(MARK), F.ltrim(value, F.lit(MARK))).otherwise(unmarked(value))


def get_string(record: Column | str, path: str) -> Column:
    """Scalar as text, object or array as JSON text, NULL for JSON null or absent."""
    return plain(F.try_variant_get(record, path, "string"))


def get_long(record: Column | str, path: str) -> Column:
    """Whole number, the fraction of others cut off; text holding a number counts, other text gives NULL."""
    text = F.ltrim(F.try_variant_get(record, path, "string"), F.lit(MARK))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,18)").try_cast("bigint"))


def get_object(record: Column | str, path: str = "$") -> Column:
    return F.try_variant_get(record, path, OBJECT)


def get_text_object(record: Column | str, path: str = "$") -> Column:
    """Object whose values are all turned to text."""
    return F.transform_values(F.try_variant_get(record, path, TEXT_OBJECT), lambda _, x: plain(x))


def get_array(record: Column | str, path: str = "$") -> Column:
    """Array of objects; an element that is not an object becomes NULL."""
    return F.try_variant_get(record, path, OBJECTS)


def is_object(record: Column | str, path: str = "$") -> Column:
    return F.try_variant_get(record, path, "struct<>").isNotNull()


def present(record: Column | str, path: str) -> Column:
    """True when the field exists and is not JSON null (``{}`` and ``""`` are present)."""
    return holds(F.try_variant_get(record, path, "variant"))


def holds(value: Column) -> Column:
    """True for a VARIANT that is neither NULL nor JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def text(value: Column | str) -> Column:
    """A text value as VARIANT, ready for :func:`put`."""
    return (F.lit(value) if isinstance(value, str) else value).cast("variant")


def remove(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda k, _: ~k.isin(*names))


def put(fields: Column, name: str, value: Column) -> Column:
    return F.map_concat(remove(fields, name), F.create_map(F.lit(name), value))


def to_text(fields: Column) -> Column:
    return unmarked(F.to_json(fields))


def without_nulls(text: Column) -> Column:
    """JSON text without the null members of its objects, at any depth; null elements of arrays stay.

    Walks whole strings, so quoted text is safe: null members go with the comma behind them, then commas before a
    closing brace.
    """
    members = F.regexp_replace(text, rf"{_STRING}\s*+:\s*+null\s*+,?+|({_STRING})", "$1")
    return F.when(text.contains("null"), F.regexp_replace(members, rf"({_STRING})|,(?=\s*+\}})", "$1")).otherwise(text)
