"""Split app-log records into error, start, page, display and action streams.

Two steps with the flag repair between them:

* :func:`cut` takes a record apart into JSON texts, one per member and one per display or action;
* :func:`fan_out` puts the output messages together from these texts.

All JSON work happens before the join of the repair, the join moves text only, and after it
there is nothing but concatenation, in one pass for all streams.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions import records
from weir.operators.visitors import NEW, NO_PAGE, OLD

# Output topics.
PAGE = "dwd_traffic_page_log"
START = "dwd_traffic_start_log"
DISPLAY = "dwd_traffic_display_log"
ACTION = "dwd_traffic_action_log"
ERROR = "dwd_traffic_error_log"
DIRTY = "dirty"

TOPICS = (PAGE, START, DISPLAY, ACTION, ERROR, DIRTY)

_OBJECTS = ("common", "start", "page", "err")
_ARRAYS = ("displays", "actions")
_MEMBERS = (*_OBJECTS, *_ARRAYS, "ts")

# What a display and an action take from their record, replacing members of the same name.
_FROM_RECORD = {"displays": ("common", "page_id", "ts"), "actions": ("common", "page_id")}

_SPACE = " \t\r\n"


def cut(logs: DataFrame) -> DataFrame:
    """Parsed records (``visitors.parse_logs``) to texts.

    Replaces ``v``, ``value`` and ``text`` by one JSON text per known member (NULL when absent or JSON null),
    ``rest`` (the other members), ``page_id``, and ``display_items`` and ``action_items`` (the
    members of each element but for those it takes from its record).

    Texts are slices of the message, numbers as they came and null members left out. Serialising
    VARIANTs costs many times more and is left to members of unexpected types.
    """
    schema = [f"{name} STRING" for name in _OBJECTS] + [f"{name} ARRAY<STRING>" for name in _ARRAYS]
    kept = ("seq", "raw", "mid", "device", "is_new", "ts", "reason")
    known = sum((F.col(f"f_{name}").isNotNull().cast("int") for name in _MEMBERS), F.lit(0))
    others = F.map_filter("fields", lambda k, _: ~k.isin(*_MEMBERS))
    start, page = F.col("f_start"), F.col("reason").isNull() & F.col("f_start").isNull()
    whole = start.isNotNull() | F.col("f_err").isNotNull()
    return (
        logs.select(
            *kept,
            # The JSON reader writes slices anew; marked numbers are texts to it.
            F.from_json("text", ", ".join(schema)).alias("slices"),
            F.map_filter(records.get_object("v"), lambda _, x: records.holds(x)).alias("fields"),
        )
        .select("*", *[F.col("fields")[name].alias(f"f_{name}") for name in _MEMBERS])
        .select("*", *[F.when(_all_objects(name), F.col("slices")[name]).alias(name) for name in _ARRAYS])
        .select(
            *kept,
            *[_object_text(name).alias(name) for name in _OBJECTS],
            *[F.when(whole, _array_text(name)).alias(name) for name in _ARRAYS],
            records.unmarked(F.to_json("f_ts")).alias("ts_text"),
            F.when(F.size("fields") > known, _inside(_clean(F.to_json(others)))).alias("rest"),
            records.get_string("f_page", "$.page_id").alias("page_id"),
            F.when(page, _items("displays")).alias("display_items"),
            F.when(page, _items("actions")).alias("action_items"),
        )
    )


def fan_out(pieces: DataFrame, topics: Iterable[str] = TOPICS) -> DataFrame:
    """Cut and repaired records to ``(seq, topic, position, value, reason)``; only ``topics`` are built.

    ``position`` counts the messages of a record on one topic from 0, so ``seq``, ``topic`` and ``position`` name a message.

    * error: the whole record, when ``err`` is present
    * start: the record without ``err``, when ``start`` is present
    * page: otherwise, the record without ``err``, ``displays`` and ``actions``
    * display, action: of page records, one row per element, with ``common`` as JSON text and
      ``page_id``; a display takes the record's ``ts``, an action keeps its own
    * dirty: the message as it came, with a ``reason``
    """
    wanted = set(topics)
    repaired = pieces.withColumn(
        "common", F.when(F.col("flipped"), _flip(F.col("common"))).otherwise(F.col("common"))
    )
    usable = F.col("reason").isNull()
    is_start = usable & F.col("start").isNotNull()
    is_page = usable & F.col("start").isNull()
    has_error = (usable | (F.col("reason") == NO_PAGE)) & F.col("err").isNotNull()
    bodies = {
        ERROR: F.when(has_error, F.array(_record("common", "start", "page", "displays", "actions", "err"))),
        START: F.when(is_start, F.array(_record("common", "start", "page", "displays", "actions"))),
        PAGE: F.when(is_page, F.array(_record("common", "page"))),
        DISPLAY: F.when(is_page, F.col("display_items")),
        ACTION: F.when(is_page, F.col("action_items")),
        DIRTY: F.when(~usable, F.array("raw")),
    }
    routes = [
        F.struct(F.lit(topic).alias("topic"), bodies[topic].alias("bodies"))
        for topic in TOPICS
        if topic in wanted
    ]
    # What displays and actions take from their record, the closing brace included.
    shared = F.substring(F.to_json(F.struct("common", "page_id")), F.lit(2), F.lit(2**31 - 1))
    record_ts = F.when(F.col("topic") == DISPLAY, F.concat(F.lit('"ts":'), F.col("ts")))
    item = F.concat(F.lit("{"), F.concat_ws(",", F.nullif("body", F.lit("")), record_ts, "shared"))
    return (
        repaired.withColumn("shared", F.when(is_page, shared))
        .select("seq", "reason", "ts", "shared", F.inline(F.array(*routes)))
        .select("*", F.posexplode("bodies").alias("position", "body"))
        .select(
            "seq",
            "topic",
            "position",
            F.when(F.col("topic").isin(DISPLAY, ACTION), item).otherwise(F.col("body")).alias("value"),
            F.when(F.col("topic") == DIRTY, F.col("reason")).alias("reason"),
        )
    )


def _object_text(name: str) -> Column:
    """JSON text of a member. A text member is not sliced: its slice lacks the quotes."""
    field = F.col(f"f_{name}")
    return _clean(F.coalesce(F.when(records.is_object(field), F.col("slices")[name]), F.to_json(field)))


def _clean(text: Column) -> Column:
    """A piece of a message as it goes out."""
    return records.unmarked(records.without_nulls(text))


def _all_objects(name: str) -> Column:
    elements = F.try_variant_get(f"f_{name}", "$", "array<struct<>>")
    return F.forall(elements, lambda e: e.isNotNull())


def _array_text(name: str) -> Column:
    sliced = F.concat(F.lit("["), F.array_join(name, ","), F.lit("]"))
    return _clean(F.coalesce(sliced, F.to_json(f"f_{name}")))


def _items(name: str) -> Column:
    """The members of each element of an array, without what the record provides.

    Elements that are not objects are skipped.
    """
    taken = _FROM_RECORD[name]
    objects = F.filter(records.get_array(f"f_{name}"), lambda e: e.isNotNull())
    built = F.transform(objects, lambda e: _inside(_clean(F.to_json(records.remove(e, *taken)))))
    sliced = F.transform(name, lambda e: _inside(_clean(e)))
    return F.coalesce(F.transform(sliced, lambda e: _without(e, taken)), built)


def _without(inner: Column, names: tuple[str, ...]) -> Column:
    """A JSON object's text, given without braces, but for the members ``names``.

    Without escapes a quoted name before a colon is a member's name, and without nested
    values the member ends at the next comma; other objects are parsed.
    """
    named = F.lit(False)
    for name in names:
        named = named | inner.contains(f'"{name}"')
    escaped = inner.contains("\\")
    nested = inner.contains("{") | inner.contains("[")
    member = rf'"({"|".join(names)})"\s*:\s*("[^"]*"|[^,"]*),?'
    parsed = records.remove(records.get_object(records.parse(F.concat(F.lit("{"), inner, F.lit("}")))), *names)
    return (
        F.when(~escaped & ~named, inner)
        .when(~escaped & ~nested, F.btrim(F.regexp_replace(inner, member, ""), F.lit(_SPACE + ",")))
        .otherwise(_inside(records.to_text(parsed)))
    )


def _inside(text: Column) -> Column:
    """A JSON object's text without its braces."""
    return F.btrim(F.substring(text, F.lit(2), F.length(text) - 2), F.lit(_SPACE))


def _record(*names: str) -> Column:
    """JSON text of the record with these members, its ``ts`` and all others not named here."""
    members = [F.concat(F.lit(f'"{name}":'), F.col(name)) for name in names]
    members += [F.concat(F.lit('"ts":'), F.col("ts_text")), F.col("rest")]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _flip(common: Column) -> Column:
    """``common`` with ``is_new`` set to ``0``.

    Without escapes and nested objects the member can only be the one that is looked for, and
    is replaced in the text; otherwise the object is rebuilt.
    """
    written, settled = f'"is_new":"{NEW}"', f'"is_new":"{OLD}"'
    simple = (
        common.contains(written)
        & ~common.contains("\\")
        & ~F.substring(common, F.lit(2), F.length(common)).contains("{")
    )
    fields = records.get_object(records.parse(common))
    rebuilt = records.to_text(records.put(fields, "is_new", records.text(OLD)))
    return F.when(simple, F.replace(common, F.lit(written), F.lit(settled))).otherwise(rebuilt)
