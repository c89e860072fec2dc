import json
from datetime import datetime

import pytest

from tramline import schemas
from tramline.operators import messages

FULL = {
    "id": "a",
    "applicationPeriods": [
        {"begin": "20240131T080000", "end": "20240131T100000"},
        {"begin": "20250101T000000", "end": "20250102T000000"},
    ],
    "cause": "TRAVAUX",
    "lastUpdate": "20240130T070000",
    "message": "<p>« Fermé »\n</p>",
    "severity": "BLOQUANTE",
    "title": "Métro 4",
    "other": {"x": 1},
}


def landed(spark, *payloads):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p, ensure_ascii=False) for p in payloads]
    return spark.createDataFrame([(t,) for t in texts], schemas.LANDED).coalesce(1)


def flat(spark, *payloads, **options):
    return messages.flatten(messages.parse_payload(landed(spark, *payloads)), **options).collect()


def test_flatten(spark):
    (row,) = flat(spark, FULL)
    assert row.asDict() == {
        "id": "a",
        "begin": datetime(2024, 1, 31, 8),
        "end": datetime(2024, 1, 31, 10),
        "cause": "TRAVAUX",
        "update_date": datetime(2024, 1, 30, 7),
        "message": "<p>« Fermé »\n</p>",
        "pattern": "BLOQUANTE",
        "title": "Métro 4",
        "year": 2024,
    }


def test_schema(spark):
    rows = messages.flatten(messages.parse_payload(landed(spark, FULL)))
    assert rows.schema == schemas.MESSAGES


def test_raw_update(spark):
    (row,) = flat(spark, FULL, parse_update=False)
    assert row["lastUpdate"] == "20240130T070000" and "year" not in row


def test_bad_payloads_give_nulls(spark):
    no_period = {**FULL, "applicationPeriods": []}
    bad_time = {**FULL, "lastUpdate": "yesterday", "applicationPeriods": [{"begin": "x"}]}
    bare = {"id": "b", "message": None}
    rows = flat(spark, no_period, bad_time, bare, "{not json", None)
    assert len(rows) == 5
    assert [r["begin"] for r in rows] == [None] * 5
    assert [r["id"] for r in rows] == ["a", "a", "b", None, None]
    assert rows[0]["update_date"] == datetime(2024, 1, 30, 7) and rows[1]["update_date"] is None
    assert rows[2]["cause"] is None and rows[2]["message"] is None


def test_inferred_schema(spark):
    texts = landed(spark, FULL, {"id": "b", "cause": None, "score": 1.5, "tags": [None]}, "{bad", None)
    schema = messages.infer_payload_schema(texts)
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert kinds == {
        "id": "string",
        "applicationPeriods": "array<struct<begin:string,end:string>>",
        "cause": "string",
        "lastUpdate": "string",
        "message": "string",
        "severity": "string",
        "title": "string",
        "other": "struct<x:bigint>",
        "score": "double",
        "tags": "array<string>",
    }
    parsed = messages.flatten(messages.parse_payload(texts, messages.with_payload_types(schema)))
    fixed = messages.flatten(messages.parse_payload(texts))
    assert parsed.collect() == fixed.collect()


def test_mixed_types_are_inferred_as_strings(spark):
    texts = landed(spark, {"id": 5, "tags": [1, "x"]}, {"id": "a", "tags": [None]}, {"id": None})
    schema = messages.infer_payload_schema(texts)
    assert schema.simpleString() == "struct<id:string,tags:array<string>>"
    parsed = messages.flatten(messages.parse_payload(texts, messages.with_payload_types(schema)))
    assert [r["id"] for r in parsed.collect()] == ["5", "a", None]


def test_inference_of_nothing(spark):
    assert not messages.infer_payload_schema(landed(spark)).fields
    assert not messages.infer_payload_schema(landed(spark, "{bad")).fields


ODD_BATCHES = {
    "few fields": [{"id": "b"}],
    "no periods": [{"id": "a", "applicationPeriods": []}, {"id": "b", "applicationPeriods": []}],
    "no end": [{"id": "a", "applicationPeriods": [{"begin": "20240131T080000"}]}],
    "other types": [{"id": 7, "cause": 3, "title": True, "message": {"x": 1}, "applicationPeriods": "none"}],
    "all malformed": ["{bad1", "{bad2"],
}


@pytest.mark.parametrize("name", ODD_BATCHES)
def test_inference_never_changes_rows_or_types(spark, name):
    texts = landed(spark, *ODD_BATCHES[name])
    schema = messages.with_payload_types(messages.infer_payload_schema(texts))
    rows = messages.flatten(messages.parse_payload(texts, schema))
    assert rows.schema == schemas.MESSAGES
    assert rows.collect() == messages.flatten(messages.parse_payload(texts)).collect()
    assert rows.count() == len(ODD_BATCHES[name])


def test_bulk_documents_split_without_loss(spark):
    document = {"disruptions": [FULL, {"id": "z"}], "lines": []}
    parts = messages.explode_bulk(landed(spark, document, {"disruptions": []}, "{bad")).collect()
    assert [json.loads(r["value"]) for r in parts] == [FULL, {"id": "z"}]


def test_kafka_encoding_keeps_nulls(spark):
    rows = spark.createDataFrame([("é", None, 1)], "a string, b string, c int")
    assert json.loads(messages.to_kafka_value(rows).first()["value"]) == {"a": "é", "b": None, "c": 1}


def test_decode_drops_the_envelope(spark):
    record = (None, bytearray("é".encode()), "t", 0, 1, None, 0)
    envelope = spark.createDataFrame([record], schemas.KAFKA_ENVELOPE)
    assert messages.decode_kafka(envelope).collect() == [("é",)]


def test_payload_is_parsed_once(spark, plan_of):
    plan = plan_of(messages.flatten(messages.parse_payload(landed(spark, FULL))))
    assert plan.count("from_json") == 1
