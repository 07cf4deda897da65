"""The ``events`` table seen as edits, and as raw JSON events.

This is the mapping of FIXTURES.md: a deterministic projection that reaches every branch of the
operators, so that the same rows can be derived in another SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.schemas import EDIT_MESSAGE

RAW_TYPES = {6: "new", 7: "categorize", 8: "log", 9: "external"}
OTHER_SITE = "de.wikipedia.org"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def edits(events: DataFrame) -> DataFrame:
    """One edit message per event, with the columns of ``EDIT_MESSAGE``."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    sign = F.when(kind.isin("error", "click"), -1).otherwise(1)
    comment = (
        F.when(kind == "error", "Undid revision 1")
        .when(kind == "click", "rv vandalism")
        .when(kind == "signup", "Reverted edits by X")
        .when(kind == "purchase", "")
    )
    columns = {
        "id": F.when(F.col("event_id") % 97 != 0, F.col("event_id")),
        "title": F.concat(F.lit("Page_"), k.cast("string")),
        "wiki": F.lit("enwiki"),
        "namespace": k % 16,
        "user": F.when(
            F.col("event_id") % 89 != 0,
            F.concat(F.lit("user_"), F.col("user_id").cast("string")),
        ),
        "bot": F.when(F.col("event_id") % 83 != 0, F.col("user_id") % 5 == 0),
        "minor": kind == "view",
        "timestamp": F.unix_seconds(F.col("ts").cast("timestamp")),
        "comment": comment,
        "length_old": F.when(kind != "signup", 1000),
        "length_new": F.lit(1000) + sign * F.floor("value").cast("int"),
        "revision_old": F.col("event_id"),
        "revision_new": F.col("event_id") + 1,
        "server_name": F.lit(fixed.SITE),
    }
    return events.select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in EDIT_MESSAGE]
    )


# Event number modulo -> what happens to its text; the first rule that fits wins.
SPOILED = {
    "empty": 41,
    "blank": 43,
    "truncated": 47,
    "scalar": 53,
    "array": 59,
    "mistyped id": 61,
    "no length": 67,
    "null length": 71,
    "no comment": 73,
}


def _spoiled(text: Column, number: Column) -> Column:
    """The texts of some events made blank, broken, mistyped or incomplete."""
    length = r'"length":\{[^}]*\},'
    made = {
        "empty": F.lit(""),
        "blank": F.lit(" \t "),
        "truncated": F.substring_index(text, "}", 2),
        "scalar": F.lit("5"),
        "array": F.lit("[1]"),
        "mistyped id": F.regexp_replace(text, r'"id":(null|\d+)', '"id":"x"'),
        "no length": F.regexp_replace(text, length, ""),
        "null length": F.regexp_replace(text, length, '"length":null,'),
        "no comment": F.regexp_replace(text, r'"comment":(null|"[^"]*"),', ""),
    }
    result = text
    for name, modulo in reversed(SPOILED.items()):
        result = F.when(number % modulo == 0, made[name]).otherwise(result)
    return result


def raw_events(events: DataFrame) -> DataFrame:
    """One JSON text per event in a column ``value``; nulls are written out."""
    number = F.col("revision_old")
    kind = F.lit("edit")
    for remainder, name in RAW_TYPES.items():
        kind = F.when(number % 10 == remainder, name).otherwise(kind)
    is_log = number % 10 == 8
    site = F.when(number % 13 == 0, OTHER_SITE).when(number % 29 != 0, F.col("server_name"))

    def pair(name: str) -> Column:
        old, new = F.col(f"{name}_old"), F.col(f"{name}_new")
        return F.struct(old.alias("old"), new.alias("new")).alias(name)

    event = F.struct(
        kind.alias("type"),
        "id", "title", "wiki", "namespace", "user", "bot", "minor", "timestamp", "comment",
        pair("length"),
        pair("revision"),
        F.when(is_log, "delete").alias("log_type"),
        F.when(is_log, "restore").alias("log_action"),
        site.alias("server_name"),
    )
    text = _spoiled(F.to_json(event, {"ignoreNullFields": "false"}), number)
    # one row out per row in: without the explode, Catalyst would write the JSON text anew for
    # every later expression that reads it
    return edits(events).select(F.explode(F.array(text)).alias("value"))


# Shares of edits, in thousandths, by how many seconds their features took.
LAGS = ((700, 1), (900, 4), (970, 20), (1000, 90))


def with_stamps(silver: DataFrame) -> DataFrame:
    """Arrival two seconds after the edit, and features after one of :data:`LAGS`."""
    rank = F.col("revision_old") * 7919 % 1000
    lag = F.lit(None).cast("int")
    for below, seconds in reversed(LAGS):
        lag = F.when(rank < below, seconds).otherwise(lag)
    arrived = F.col("edit_timestamp") + F.make_dt_interval(secs=F.lit(2))
    return silver.withColumn("ingested_at", arrived).withColumn(
        "silver_processed_at", arrived + F.make_dt_interval(secs=lag)
    )


# Labels of a caller: some namespaces have another one, one has none, one is beyond the usual ones.
OWN_LABELS = ((0, "Main"), (1, "Discussion"), (2, None), (8, "Message"), (10, "Template"))


def own_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OWN_LABELS, "namespace int, label string")
