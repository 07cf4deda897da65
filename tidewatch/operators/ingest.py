"""Raw JSON events -> routed messages ``(topic, key, value)``.

Input is any DataFrame, batch or streaming, with a string column ``value`` holding one JSON text
per row.  The output has the row shape the Kafka sink takes.  Everything is filter and projection:
no shuffle, no state.

Most of a feed belongs to other sites, so a substring test drops rows before any parsing, and what
is left is parsed once.  A row with a field of an unexpected type is read again as ``variant``, so
that the field is passed on as it came.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.schemas import EDIT_MESSAGE, MISTYPED, NESTED_FIELDS, PAGE_MESSAGE, RAW_EVENT

# Fixed value: white space that may surround a JSON text.
JSON_BLANKS = " \t\r\n"

_STRICT = {"allowSingleQuotes": "false"}
_KEEP_NULLS = {"ignoreNullFields": "false"}


def routes(
    edit_types: Iterable[str] = fixed.EDIT_TYPES, page_types: Iterable[str] = fixed.PAGE_TYPES
) -> dict[str, str]:
    """Event type -> topic."""
    return {
        **dict.fromkeys(edit_types, fixed.EDIT_TOPIC),
        **dict.fromkeys(page_types, fixed.PAGE_TOPIC),
    }


def drop_blank(raw: DataFrame) -> DataFrame:
    """Drop payloads that are null, empty or white space only."""
    return raw.filter(F.length(F.btrim("value", F.lit(JSON_BLANKS))) > 0)


def may_name(value: Column, text: str) -> Column:
    """False only if no JSON string in ``value`` can equal ``text``.

    A string without backslash escapes is spelled out literally, so a value with neither the text
    nor a backslash needs no parsing.
    """
    return value.contains(text) | value.contains("\\")


def _object_shaped(value: Column) -> Column:
    """True for texts in braces.  Trimming is left for the few that are not as they stand."""

    def braced(text):
        return text.startswith("{") & text.endswith("}")

    return braced(value) | braced(F.btrim(value, F.lit(JSON_BLANKS)))


def decode(raw: DataFrame) -> DataFrame:
    """Add ``event``, the typed fields, and ``loose``, the variant of rows with a mistyped field.

    Payloads that are not one JSON object are dropped, blank ones among them.
    """
    options = {**_STRICT, "columnNameOfCorruptRecord": MISTYPED}
    # The explode of one element changes no row; it keeps filters on ``event`` from being pushed
    # below the parse, where each of them would parse the text again.
    parsed = F.explode(F.array(F.from_json("value", RAW_EVENT, options)))
    mistyped = F.col(f"event.{MISTYPED}").isNotNull()
    return (
        raw.filter(_object_shaped(F.col("value")))
        .select("*", parsed.alias("event"))
        .withColumn("loose", F.when(mistyped, F.try_parse_json("value")))
        .filter(~mistyped | F.col("loose").isNotNull() | F.col("event.type").isNotNull())
    )


def keep_site(events: DataFrame, site: str = fixed.SITE) -> DataFrame:
    """Keep the events of one site; a missing site drops the event."""
    return events.filter(F.col("event.server_name") == site)


def route(events: DataFrame, topics: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``topic`` by event type; events of any other type, or none, are dropped."""
    topics = topics or routes()
    entries = [F.lit(part) for entry in topics.items() for part in entry]
    return events.filter(F.col("event.type").isin(*topics)).withColumn(
        "topic", F.try_element_at(F.create_map(*entries), F.col("event.type"))
    )


def _typed_field(name: str) -> Column:
    # struct access on a null parent gives null
    field = F.col(f"event.{NESTED_FIELDS.get(name, name)}")
    if name != "comment":
        return field
    # looked at only where there is no text; the keys are null for number forms like NaN
    keys = F.coalesce(F.json_object_keys("value"), F.array())
    present = F.array_contains(keys, "comment")
    return F.when(field.isNotNull(), field).when(~present, fixed.ABSENT_COMMENT)


def _loose_field(name: str) -> Column:
    field = F.try_variant_get("loose", f"$.{NESTED_FIELDS.get(name, name)}", "variant")
    if name != "comment":
        return field
    # an explicit JSON null is a variant value, only an absent key is null
    return F.coalesce(field, F.parse_json(F.lit(json.dumps(fixed.ABSENT_COMMENT))))


def _payload(fields: Iterable[str]) -> Column:
    """The message body as JSON text, with null fields written out."""
    fields = list(fields)
    typed = F.struct(*[_typed_field(name).alias(name) for name in fields])
    loose = F.struct(*[_loose_field(name).alias(name) for name in fields])
    return F.when(F.col("loose").isNull(), F.to_json(typed, _KEEP_NULLS)).otherwise(
        F.to_json(loose, _KEEP_NULLS)
    )


def edit_payload() -> Column:
    return _payload(EDIT_MESSAGE.names)


def page_payload() -> Column:
    return _payload(PAGE_MESSAGE.names)


def message_key() -> Column:
    typed, loose = F.col("event.id").cast("string"), F.try_variant_get("loose", "$.id", "string")
    return F.coalesce(typed, loose, F.lit(fixed.NULL_KEY))


def messages(
    raw: DataFrame, site: str = fixed.SITE, topics: Mapping[str, str] | None = None
) -> DataFrame:
    """The whole step: raw events in, ``topic, key, value`` out."""
    events = decode(raw.filter(may_name(F.col("value"), site)))
    routed = route(keep_site(events, site), topics)
    body = F.when(F.col("topic") == fixed.EDIT_TOPIC, edit_payload()).otherwise(page_payload())
    return routed.select("topic", message_key().alias("key"), body.alias("value"))
