"""Schemas of events and messages, and of the record envelope messages arrive in."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LONG, INT, TEXT, FLAG = LongType(), IntegerType(), StringType(), BooleanType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# Field names and types of the two message kinds.
EDIT_MESSAGE = _struct(
    id=LONG,
    title=TEXT,
    wiki=TEXT,
    namespace=INT,
    user=TEXT,
    bot=FLAG,
    minor=FLAG,
    timestamp=LONG,
    comment=TEXT,
    length_old=INT,
    length_new=INT,
    revision_old=LONG,
    revision_new=LONG,
    server_name=TEXT,
)
PAGE_MESSAGE = _struct(
    id=LONG,
    title=TEXT,
    wiki=TEXT,
    namespace=INT,
    user=TEXT,
    bot=FLAG,
    timestamp=LONG,
    comment=TEXT,
    log_type=TEXT,
    log_action=TEXT,
    server_name=TEXT,
)

# Message fields that sit one level down in the raw event.
NESTED_FIELDS = {
    "length_old": "length.old",
    "length_new": "length.new",
    "revision_old": "revision.old",
    "revision_new": "revision.new",
}

# The raw event, with a column that is set when a field has another type than declared here.
MISTYPED = "mistyped"
RAW_EVENT = _struct(
    type=TEXT,
    id=LONG,
    title=TEXT,
    wiki=TEXT,
    namespace=INT,
    user=TEXT,
    bot=FLAG,
    minor=FLAG,
    timestamp=LONG,
    comment=TEXT,
    length=_struct(old=INT, new=INT),
    revision=_struct(old=LONG, new=LONG),
    log_type=TEXT,
    log_action=TEXT,
    server_name=TEXT,
    **{MISTYPED: TEXT},
)

# What a message source delivers, whatever the connector.
RECORD = _struct(value=BinaryType(), timestamp=TimestampType(), offset=LONG, partition=INT)

# The bronze tables: a message, where and when it came from, and when it was taken in.
_ARRIVAL = _struct(
    kafka_timestamp=TimestampType(), offset=LONG, partition=INT, ingested_at=TimestampType()
)
BRONZE_EDITS = StructType(EDIT_MESSAGE.fields + _ARRIVAL.fields)
BRONZE_PAGE_EVENTS = StructType(PAGE_MESSAGE.fields + _ARRIVAL.fields)

# What the topic sink takes.
TOPIC_MESSAGE = _struct(topic=TEXT, key=TEXT, value=TEXT)

# Which file a record is from, where it is from a file and that is asked for.
SOURCE_FILE = "source_file"
