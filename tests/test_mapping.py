import json

from pyspark.sql import functions as F

from eventide.model import m
from eventide.operators.mapping import compile_mappings


def mapped(payloads, payload, mappings):
    df = compile_mappings(payloads(payload), mappings)
    r = df.select(F.to_json("mapped").alias("o"), "map_error").first()
    return json.loads(r["o"]), r["map_error"]


def test_direct(payloads):
    out, err = mapped(payloads, {"userId": 1, "name": "A"}, [m("userId", "customerId"), m("name", "customerName")])
    assert out == {"customerId": 1, "customerName": "A"} and err is None


def test_typed(payloads):
    out, _ = mapped(payloads, {"total": "49.99", "count": 3},
                    [m("total", "amount", "TO_DOUBLE"), m("count", "quantity", "TO_STRING")])
    assert out == {"amount": 49.99, "quantity": "3"}


def test_nested_source(payloads):
    out, _ = mapped(payloads, {"address": {"city": "X", "country": "NL"}},
                    [m("address.city", "city"), m("address.country", "countryCode")])
    assert out == {"city": "X", "countryCode": "NL"}


def test_nested_destination(payloads):
    out, _ = mapped(payloads, {"city": "X", "country": "NL"},
                    [m("city", "location.city"), m("country", "location.country")])
    assert out == {"location": {"city": "X", "country": "NL"}}


def test_excluded(payloads):
    out, _ = mapped(payloads, {"name": "A", "password": "p"},
                    [m("name", "name"), m("password", "password", excluded=True)])
    assert out == {"name": "A"}


def test_default(payloads):
    out, _ = mapped(payloads, {"name": "A"}, [m("name", "name"), m("currency", "currency", default="EUR")])
    assert out == {"name": "A", "currency": "EUR"}


def test_default_converted(payloads):
    out, _ = mapped(payloads, {}, [m("n", "n", "TO_INTEGER", default="7")])
    assert out == {"n": 7}


def test_dynamic_now_and_uuid(payloads):
    out, _ = mapped(payloads, {"name": "A"}, [m("x", "processedAt", default="${now}"), m("y", "id", default="${uuid}")])
    assert out["processedAt"] and len(out["id"]) == 36


def test_upper_mask(payloads):
    out, _ = mapped(payloads, {"country": "nl", "email": "john@x.com"},
                    [m("country", "country", "TO_UPPER"), m("email", "email", "MASK")])
    assert out == {"country": "NL", "email": "j********m"}


def test_missing_skipped(payloads):
    out, _ = mapped(payloads, {"name": "A"}, [m("name", "name"), m("nonexistent", "other")])
    assert out == {"name": "A"}


def test_json_null_is_missing(payloads):
    out, _ = mapped(payloads, {"a": None}, [m("a", "a"), m("a", "b", default="d")])
    assert out == {"b": "d"}


def test_all_absent_root_is_empty_object(payloads):
    out, _ = mapped(payloads, {"x": 1}, [m("nope", "a.b")])
    assert out == {}


def test_null_payload(payloads):
    out, _ = mapped(payloads, "null", [m("a", "a"), m("b", "b", default="z")])
    assert out == {"b": "z"}


def test_non_object_on_path_is_missing(payloads):
    out, _ = mapped(payloads, {"a": "s", "arr": [{"b": 1}]}, [m("a.b", "x"), m("arr.b", "y"), m("arr.0.b", "z")])
    assert out == {}


def test_flatten_root(payloads):
    out, _ = mapped(payloads, {"address": {"city": "X", "zip": "1"}}, [m("address", "", "FLATTEN")])
    assert out == {"city": "X", "zip": "1"}


def test_flatten_nested(payloads):
    out, _ = mapped(payloads, {"address": {"city": "X", "country": "NL"}}, [m("address", "shipping", "FLATTEN")])
    assert out == {"shipping": {"city": "X", "country": "NL"}}


def test_flatten_non_object_passes(payloads):
    out, _ = mapped(payloads, {"a": 5}, [m("a", "b", "FLATTEN")])
    assert out == {"b": 5}


def test_later_present_write_wins(payloads):
    out, _ = mapped(payloads, {"a": 1, "b": 2}, [m("a", "x"), m("b", "x"), m("zz", "x")])
    assert out == {"x": 2}


def test_value_then_object(payloads):
    out, _ = mapped(payloads, {"a": 1, "b": 2}, [m("a", "x"), m("b", "x.y")])
    assert out == {"x": {"y": 2}}


def test_object_then_value(payloads):
    out, _ = mapped(payloads, {"a": 1, "b": 2}, [m("b", "x.y"), m("a", "x")])
    assert out == {"x": 1}


def test_object_value_extended(payloads):
    out, _ = mapped(payloads, {"o": {"p": 1}, "b": 2}, [m("o", "x"), m("b", "x.q")])
    assert out == {"x": {"p": 1, "q": 2}}


def test_trailing_dot_path(payloads):
    out, _ = mapped(payloads, {"a": 1}, [m("a.", "b.")])
    assert out == {"b": 1}


def test_first_error_wins(payloads):
    _, err = mapped(payloads, {"a": "x", "b": "y"}, [m("a", "a", "TO_INTEGER"), m("b", "b", "TO_DOUBLE")])
    assert err == 'For input string: "x"'


def test_error_only_when_applied(payloads):
    out, err = mapped(payloads, {"b": "1"}, [m("a", "a", "TO_INTEGER"), m("b", "b", "TO_INTEGER")])
    assert err is None and out == {"b": 1}


def test_quoted_keys(payloads):
    out, _ = mapped(payloads, {"it's": {"a-b c": 1}}, [m("it's.a-b c", "o\"k")])
    assert out == {"o\"k": 1}


def test_flatten_nests_dotted_keys_below_a_prefix(payloads):
    out, _ = mapped(payloads, {"o": {"x.y": 1, "x.z.q": 2, "x.z.r": {"k": 1}, "w": 3}}, [m("o", "p", "FLATTEN")])
    assert out == {"p": {"x": {"y": 1, "z": {"q": 2, "r": {"k": 1}}}, "w": 3}}
    out, _ = mapped(payloads, {"v": 0, "o": {"x": {"a": 1}, "x.b": 2, "t.": 5}},
                    [m("v", "p.x.old"), m("v", "p.kept"), m("o", "p", "FLATTEN")])
    assert out == {"p": {"kept": 0, "x": {"a": 1, "b": 2}, "t": 5}}
    out, _ = mapped(payloads, {"o": {"x.y": 1}}, [m("o", "", "FLATTEN")])
    assert out == {"x.y": 1}
