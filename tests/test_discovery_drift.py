import datetime as dt
import json

from pyspark.sql import functions as F

from eventide.functions.text import drift_text, schema_hash
from eventide.operators.detect import drift as D
from eventide.operators.discovery import discover


def found(payloads, *docs):
    return {r["path"]: (r["type"], r["occurrences"]) for r in discover(payloads(*docs)).collect()}


def test_flat(payloads):
    assert found(payloads, {"name": "test", "count": 42, "active": True, "price": 19.99}) == {
        "name": ("string", 1), "count": ("integer", 1), "active": ("boolean", 1), "price": ("double", 1)}


def test_nested(payloads):
    f = found(payloads, {"user": {"name": "a", "address": {"city": "x"}}})
    assert f == {"user": ("object", 1), "user.name": ("string", 1), "user.address": ("object", 1),
                 "user.address.city": ("string", 1)}


def test_array_first_element(payloads):
    f = found(payloads, {"items": [{"sku": "a", "qty": 1}, {"other": 1}], "nums": [1, 2]})
    assert f == {"items": ("array", 1), "items[*].sku": ("string", 1), "items[*].qty": ("integer", 1),
                 "nums": ("array", 1)}


def test_null_and_merge(payloads):
    assert found(payloads, "null") == {}
    f = found(payloads, {"a": 1, "big": 5000000000}, {"a": "x"}, "[1]", {"a": 1.5, "deep": {"b": {"c": {"d": None}}}})
    assert f["a"] == ("integer", 3) and f["big"] == ("long", 1) and f["deep.b.c.d"] == ("null", 1)


def test_hash_matches_sorted_set_text(spark):
    import hashlib
    r = spark.range(1).select(schema_hash(F.array(F.lit("a"), F.lit("b"))).alias("h")).first()["h"]
    assert r == hashlib.sha256(b"[a, b]").hexdigest()[:16]
    t = spark.range(1).select(drift_text(F.array(F.lit("discount")), F.array().cast("array<string>"))).first()[0]
    assert t == "New fields: [discount]."


def _checks(spark, batches):
    rows = []
    for i, docs in enumerate(batches):
        for j, d in enumerate(docs):
            rows.append((f"e{i}_{j}", "order", json.dumps(d), dt.datetime(2024, 1, 1 + i, 1, j)))
    df = spark.createDataFrame(rows, "id string, type string, payload string, stored_at timestamp")
    return D.schema_checks(D.check_samples(df, check="1 day")).orderBy("check_at").collect()


def test_added_removed_none(spark):
    c = _checks(spark, [[{"orderId": 1, "total": 2}], [{"orderId": 1, "total": 2, "discount": 1}],
                        [{"orderId": 1, "total": 2}], [{"orderId": 1, "total": 2}], ["not json"]])
    assert [x["outcome"] for x in c] == ["FIRST", "DRIFT", "DRIFT", "SAME", "DRIFT"]
    assert c[1]["added"] == ["discount"] and c[1]["removed"] == []
    assert c[2]["removed"] == ["discount"]
    assert c[4]["field_names"] == [] and c[4]["sample_count"] == 1


def test_events_sharing_a_seq_are_events_of_their_own(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (1, '{"a": "x"}'), (None, '{"b": true}'), (2, None)], "seq long, p string")
    got = discover(df.select("seq", F.try_parse_json("p").alias("payload")))
    assert sorted(map(tuple, got.collect())) == [("a", "string", 2), ("b", "boolean", 1)]


def test_a_repeated_path_keeps_the_type_met_last(payloads):
    got = discover(payloads({"a": {"b": "x"}, "a.b": 1}))
    assert sorted(map(tuple, got.collect())) == [("a", "object", 1), ("a.b", "integer", 1)]
