import json

from pyspark.sql import functions as F

from eventide.model import Flow, m
from eventide.operators import envelope as ENV
from eventide.operators.routing import dead_letter_rows, fan_out, route, split, transform

FLOW = Flow("test-flow", "in", "out", (m("userId", "customerId"), m("total", "amount", "TO_DOUBLE")))


def records(spark, *values):
    return spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "key string, value string")


def env(**kw):
    base = {"id": "evt_1", "type": "order.created", "source": "test", "timestamp": 1700000000.5,
            "payload": {"userId": 1, "total": "9.5"}, "status": "RECEIVED"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def test_round_trip(spark):
    df = ENV.parse_envelopes(records(spark, env()))
    out = ENV.serialize(df).select("value").first()[0]
    back = json.loads(out)
    assert back["type"] == "order.created" and back["source"] == "test"
    assert back["payload"] == {"userId": 1, "total": "9.5"} and back["status"] == "RECEIVED"
    assert "errorMessage" not in back and "processedAt" not in back


def test_malformed_and_strict(spark):
    df = ENV.parse_envelopes(records(spark, "not json", '[1]', env(extra=1), env(status="NOPE"),
                                     env(type={"a": 1}), env(timestamp="yesterday"), env()))
    assert [r[0] for r in df.orderBy("key").select("parse_ok").collect()] == [False] * 6 + [True]


def test_defaults(spark):
    r = ENV.parse_envelopes(records(spark, json.dumps({"type": "t", "source": "s", "payload": {}}),
                                    json.dumps({"id": None, "type": "t", "source": "s", "status": None}))
                            ).orderBy("key").collect()
    assert r[0]["id"].startswith("evt_") and r[0]["status"] == "RECEIVED" and r[0]["timestamp"] is not None
    assert r[1]["id"] is None and r[1]["status"] is None and r[1]["parse_ok"]


def test_iso_timestamp_and_numeric_status(spark):
    r = ENV.parse_envelopes(records(spark, env(timestamp="2024-01-01T00:00:00+01:00", status=2))).first()
    assert r["parse_ok"] and r["status"] == "PROCESSED"
    assert str(r["timestamp"]) == "2023-12-31 23:00:00"


def test_topology_success(spark):
    out = route(transform(records(spark, env()), FLOW), FLOW).collect()
    assert len(out) == 1 and out[0]["topic"] == "out" and out[0]["key"] == "k0"
    v = json.loads(out[0]["value"])
    assert v["status"] == "PROCESSED" and v["payload"] == {"customerId": 1, "amount": 9.5} and "processedAt" in v


def test_topology_bad_json_dead_letter_verbatim(spark):
    out = route(transform(records(spark, "not valid json at all"), FLOW), FLOW).collect()
    assert out[0]["topic"] == "events.failed" and out[0]["value"] == "not valid json at all"


def test_topology_five_events(spark):
    out = route(transform(records(spark, *[env(id=f"evt_{i}") for i in range(5)]), FLOW), FLOW)
    assert out.filter("topic = 'out'").count() == 5 and out.filter("topic != 'out'").count() == 0


def test_conversion_failure_keeps_payload(spark):
    t = transform(records(spark, env(payload={"userId": 1, "total": "abc"})), FLOW)
    ok, bad = split(t)
    assert ok.count() == 0
    r = route(t, FLOW).first()
    v = json.loads(r["value"])
    assert r["topic"] == "events.failed" and v["status"] == "FAILED"
    assert v["errorMessage"] == '[test-flow] For input string: "abc"'
    assert v["payload"] == {"userId": 1, "total": "abc"}
    d = dead_letter_rows(t).first()
    assert d["pipeline_name"] == "test-flow" and d["retry_count"] == 0


def test_custom_dead_letter_topic(spark):
    fl = Flow("f", "in", "out", (m("total", "a", "TO_INTEGER"),), dead_letter_topic="dlq")
    r = route(transform(records(spark, env()), fl), fl).first()
    assert r["topic"] == "dlq"


def test_requests_validation(spark):
    bodies = [json.dumps({"type": "order.created", "source": "test-service", "payload": {"orderId": 1}}),
              json.dumps({"source": "s", "payload": {}}), json.dumps({"type": "t", "source": " \t"}),
              "{bad"]
    df = spark.createDataFrame([(1, b) for b in bodies], "batch_id int, value string")
    r = ENV.parse_requests(df).collect()
    assert [x["valid"] for x in r] == [True, False, False, False]
    assert r[1]["violations"] == ["type"] and r[2]["violations"] == ["source", "payload"] and r[3]["malformed"]
    capped = ENV.check_batch_size(df, max_batch=2).select("batch_rejected", "batch_error").first()
    assert capped[0] and capped[1] == "Batch size 4 exceeds maximum of 2"
    env_ = ENV.build_envelopes(ENV.parse_requests(df).filter("valid")).first()
    assert env_["id"].startswith("evt_") and env_["status"] == "RECEIVED"


def test_table_rows(spark):
    df = ENV.to_table_rows(ENV.parse_envelopes(records(spark, env(status=None)))).first()
    assert df["status"] == "UNKNOWN" and json.loads(df["payload"]) == {"userId": 1, "total": "9.5"}
    assert df["stored_at"] is not None and df["received_at"] is not None


def test_hostile_records_are_dead_letters_not_failures(spark):
    from eventide.operators.envelope import parse_envelopes
    bad = ['"status": 7', '"status": -1', '"status": 1e30', '"timestamp": 1000000000000000',
           '"timestamp": 99999999999999999999', '"timestamp": 1e25', '"processedAt": -1e37']
    rows = [(f'{{"id": "x", "type": "t", "source": "s", "payload": {{}}, {b}}}',) for b in bad]
    got = parse_envelopes(spark.createDataFrame(rows + [('{"id": "x", "type": "t", "status": 2}',)], "value string"))
    out = got.select("parse_ok", "status", "timestamp").collect()
    assert [r["parse_ok"] for r in out] == [False] * len(bad) + [True]


def test_bodies_that_are_no_requests(spark):
    bodies = ["[1,2]", "5", "null", '{"type":{"a":1},"source":"s","payload":1}', '{"type":"t","source":"s","payload":null}']
    df = spark.createDataFrame([(i // 4, b) for i, b in enumerate(bodies)], "batch_id int, value string")
    parsed = ENV.parse_requests(df)
    got = [(r["malformed"], r["violations"]) for r in parsed.collect()]
    assert got == [(True, [])] * 4 + [(False, [])]
    batches = ENV.check_batch_requests(parsed).select("batch_id", "invalid_requests", "batch_invalid").distinct().collect()
    assert sorted(map(tuple, batches)) == [(0, 4, True), (1, 0, False)]


def test_fan_out_reads_each_definitions_own_topic(spark):
    rows = [("k1", env(), "in"), ("k2", env(payload={"total": "x"}), "in"), ("k3", "{bad", "other"), ("k4", env(), "none")]
    df = spark.createDataFrame(rows, "key string, value string, topic string")
    flows = [Flow("a", "in", "a.out", FLOW.mappings, state="ACTIVE"), Flow("b", "other", "b.out", (), state="ACTIVE"),
             Flow("c", "in", "c.out", (m("userId", "u"),), dead_letter_topic="c.dlq", state="ACTIVE")]
    got = {(r["flow"], r["key"]): r for r in fan_out(df, flows).collect()}
    assert {k: (r["topic"], r["ok"]) for k, r in got.items()} == {
        ("a", "k1"): ("a.out", True), ("a", "k2"): ("events.failed", False), ("b", "k3"): ("events.failed", False),
        ("c", "k1"): ("c.out", True), ("c", "k2"): ("c.out", True)}
    one = route(transform(df.filter("key = 'k2'"), flows[0]), flows[0]).first()
    skip = {"processedAt"}
    assert {k: v for k, v in json.loads(got["a", "k2"]["value"]).items() if k not in skip} == {
        k: v for k, v in json.loads(one["value"]).items() if k not in skip}
    assert got["b", "k3"]["value"] == "{bad"


def test_filter_on_parse_ok_does_not_repeat_the_parse(spark):
    """a record is parsed once, and absent members are looked up in its map."""
    from eventide.operators.mapping import compile_mappings
    good = ENV.parse_envelopes(records(spark, env(), "not json", env(extra=1))).filter("parse_ok")
    out = compile_mappings(good, [m("userId", "u"), m("no.such", "n"), m("total", "t")]).select("key", F.to_json("mapped"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert "$['" not in plan
    assert [tuple(r) for r in out.collect()] == [("k0", '{"t":"9.5","u":1}')]


def test_sources_below_absent_or_scalar_values(spark):
    from eventide.operators.mapping import compile_mappings
    df = spark.createDataFrame([(0, '{"a":{"b":{"c":1}},"x":5,"n":null}'), (1, '[1]'), (2, '{"a":7}'), (3, None)],
                               "seq int, p string").select("seq", F.try_parse_json("p").alias("payload"))
    out = compile_mappings(df, [m("a.b.c", "c"), m("a.b", "b"), m("x.y", "y", default="d"), m("n", "n"), m("a..b", "e")])
    assert [r[0] for r in out.orderBy("seq").select(F.to_json("mapped")).collect()] == \
        ['{"b":{"c":1},"c":1,"y":"d"}', '{"y":"d"}', '{"y":"d"}', '{"y":"d"}']
