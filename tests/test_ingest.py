"""Row-level behaviour of decoding, filtering, routing and flattening raw events."""

from __future__ import annotations

import json

import pytest

from tidewatch.operators import ingest

SITE = "en.wikipedia.org"
EDIT_FIELDS = [
    "id", "title", "wiki", "namespace", "user", "bot", "minor", "timestamp", "comment",
    "length_old", "length_new", "revision_old", "revision_new", "server_name",
]
PAGE_FIELDS = [
    "id", "title", "wiki", "namespace", "user", "bot", "timestamp", "comment", "log_type",
    "log_action", "server_name",
]


def texts(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def event(**fields):
    return json.dumps({"server_name": SITE, "type": "edit", **fields})


def sent(spark, *values):
    rows = ingest.messages(texts(spark, *values)).collect()
    return [(row.topic, row.key, json.loads(row.value)) for row in rows]


def one(spark, value):
    (row,) = sent(spark, value)
    return row


@pytest.mark.parametrize(
    "value",
    [
        None,
        "",
        "  \n",
        "not json",
        '{"server_name": "en.wikipedia.org", "type": "edit", "id": 1',
        '{"server_name": "en.wikipedia.org", "type": "edit",}',
        '{"server_name": "en.wikipedia.org", "type": "edit", "x": [1}',
        '{"server_name": "en.wikipedia.org", "type": "edit"}x',
        "{'server_name': 'en.wikipedia.org', 'type': 'edit'}",
        "5",
        "[1]",
        "null",
        '"en.wikipedia.org"',
    ],
)
def test_not_an_object_is_dropped(spark, value):
    assert sent(spark, value) == []
    assert ingest.decode(texts(spark, value)).count() == 0


def test_blank_filter(spark):
    kept = ingest.drop_blank(texts(spark, None, "", " \t\r\n", "x", " y ")).collect()
    assert [row.value for row in kept] == ["x", " y "]


def test_site_and_type_filter(spark):
    rows = sent(
        spark,
        event(id=1),
        event(id=2, type="new"),
        event(id=3, type="categorize"),
        event(id=4, type="log"),
        event(id=5, type="external"),
        event(id=6, type=None),
        event(id=7, type=["edit"]),
        event(id=8, server_name="de.wikipedia.org"),
        event(id=9, server_name=None, title=SITE),
        json.dumps({"type": "edit", "title": SITE}),
        json.dumps({"server_name": SITE, "title": "edit"}),
    )
    assert [(topic, key) for topic, key, _ in rows] == [
        ("wiki_edits", "1"),
        ("wiki_edits", "2"),
        ("wiki_page_events", "3"),
        ("wiki_page_events", "4"),
    ]


def test_site_written_with_escapes_is_found(spark):
    text = '{"server_name": "\\u0065n.wikipedia.org", "type": "\\u0065dit", "id": 1}'
    assert one(spark, text)[:2] == ("wiki_edits", "1")


def test_edit_payload_is_flat_and_complete(spark):
    topic, key, body = one(
        spark,
        event(
            id=5,
            title='a "b" é\n',
            bot=True,
            length={"old": 1, "new": 2},
            revision={"new": 9},
            x=1,
        ),
    )
    assert (topic, key) == ("wiki_edits", "5")
    assert list(body) == EDIT_FIELDS
    given = {name: value for name, value in body.items() if value is not None}
    assert given == {
        "id": 5,
        "title": 'a "b" é\n',
        "bot": True,
        "comment": "",
        "length_old": 1,
        "length_new": 2,
        "revision_new": 9,
        "server_name": SITE,
    }


def test_page_payload(spark):
    topic, key, body = one(spark, event(id=6, type="log", log_type="delete", minor=True))
    assert (topic, key) == ("wiki_page_events", "6")
    assert list(body) == PAGE_FIELDS
    assert body["log_type"] == "delete" and body["log_action"] is None


@pytest.mark.parametrize("fields", [{}, {"length": None}, {"length": 5}, {"length": {"new": None}}])
def test_missing_parent_gives_null(spark, fields):
    body = one(spark, event(**fields))[2]
    assert body["length_old"] is None and body["length_new"] is None


def test_comment_absent_null_and_nested(spark):
    assert one(spark, event())[2]["comment"] == ""
    assert one(spark, event(x={"comment": "deep"}))[2]["comment"] == ""
    assert one(spark, event(comment=None))[2]["comment"] is None
    assert one(spark, event(comment=None, id="x"))[2]["comment"] is None
    assert one(spark, event(id="x"))[2]["comment"] == ""
    assert one(spark, event(comment="c"))[2]["comment"] == "c"


def test_key(spark):
    assert one(spark, event())[1] == "None"
    assert one(spark, event(id=None))[1] == "None"
    assert one(spark, event(id=12345678901234))[1] == "12345678901234"


def test_mistyped_fields_are_passed_on(spark):
    _, key, body = one(
        spark, event(id="x", namespace=3_000_000_000, bot="no", length={"old": "a", "new": 3})
    )
    assert key == "x"
    assert body["id"] == "x" and body["namespace"] == 3_000_000_000 and body["bot"] == "no"
    assert body["length_old"] == "a" and body["length_new"] == 3


def test_repeated_key_takes_the_last_value(spark):
    text = '{"server_name": "en.wikipedia.org", "type": "edit", "id": 1, "id": 2}'
    assert one(spark, text)[1] == "2"


def test_site_and_topics_are_parameters(spark):
    rows = ingest.messages(
        texts(spark, event(id=1, server_name="x.org"), event(id=2), event(id=3, type="log")),
        site=SITE,
        topics={"log": "wiki_page_events"},
    ).collect()
    assert [row.key for row in rows] == ["3"]


def test_text_is_parsed_once(spark):
    frame = ingest.messages(texts(spark, event()))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Contains(value" in plan or "contains(value" in plan.lower()
