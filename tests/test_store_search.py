import datetime as dt

from pyspark.sql import functions as F

from eventide.operators import search as S
from eventide.operators import store as STO

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def events(spark):
    rows = [("evt_1", "order.created", "test", "PROCESSED", T0),
            ("evt_2", "user.signup", "auth", "FAILED", T0 + dt.timedelta(minutes=1)),
            ("evt_3", "order.created", "auth", "PROCESSED", T0 + dt.timedelta(minutes=2))]
    return spark.createDataFrame(rows, "id string, type string, source string, status string, received_at timestamp")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_precedence(spark):
    e = events(spark)
    assert ids(S.search(e, type="order.created", source="auth")) == ["evt_3"]
    assert ids(S.search(e, type="order.created", status="FAILED")) == ["evt_1", "evt_3"]
    assert ids(S.search(e, source="auth", status="PROCESSED")) == ["evt_2", "evt_3"]
    assert ids(S.search(e, status="FAILED")) == ["evt_2"]
    assert ids(S.search(e, from_=T0, to=T0 + dt.timedelta(minutes=1))) == ["evt_1", "evt_2"]
    assert ids(S.search(e, from_=T0)) == ["evt_1", "evt_2", "evt_3"]  # lone from ignored


def test_conjunctive(spark):
    e = events(spark)
    assert ids(S.search(e, type="order.created", status="FAILED", mode="conjunctive")) == []
    assert ids(S.search(e, source="auth", status="PROCESSED", mode="conjunctive")) == ["evt_3"]


def test_paging_and_stats(spark):
    e = events(spark)
    assert [r["id"] for r in S.page(e, 0, 2).collect()] == ["evt_3", "evt_2"]
    assert [r["id"] for r in S.page(e, 1, 2).collect()] == ["evt_1"]
    assert [r["id"] for r in S.page_after(e, T0 + dt.timedelta(minutes=1), "evt_2", 2).collect()] == ["evt_1"]
    st = S.stats(e).first()
    assert (st["total_events"], st["types"], st["sources"]) == (3, 2, 2)
    assert [r[0] for r in S.distinct_values(e, "source").collect()] == ["auth", "test"]
    assert S.get_by_id(e, "evt_2").count() == 1 and S.get_by_id(e, "nope").count() == 0


def test_land_once(spark):
    batch = spark.createDataFrame([("evt_1", "RECEIVED", 0), ("evt_1", "PROCESSED", 1), ("evt_2", "RECEIVED", 0),
                                   ("evt_3", "RECEIVED", 0)], "id string, status string, arrival int")
    existing = spark.createDataFrame([("evt_3",)], "id string")
    new = STO.land(batch, existing, [F.col("arrival")])
    assert sorted((r["id"], r["status"]) for r in new.collect()) == [("evt_1", "RECEIVED"), ("evt_2", "RECEIVED")]
    assert STO.exists(batch, existing).count() == 1


def test_upsert(spark):
    old = spark.createDataFrame([("t", "h1", 5, 1), ("t", "h2", 6, 2)], "event_type string, schema_hash string, n int, seen int")
    upd = spark.createDataFrame([("t", "h1", 9, 3), ("u", "h3", 1, 3)], "event_type string, schema_hash string, n int, seen int")
    out = {(r[0], r[1]): (r[2], r[3]) for r in STO.upsert(old, upd, ["event_type", "schema_hash"]).collect()}
    assert out == {("t", "h1"): (9, 3), ("t", "h2"): (6, 2), ("u", "h3"): (1, 3)}
    kept = {(r[0], r[1]): (r[2], r[3]) for r in
            STO.upsert(old, upd, ["event_type", "schema_hash"], keep_on_conflict=["n"]).collect()}
    assert kept[("t", "h1")] == (5, 3) and kept[("u", "h3")] == (1, 3)


def test_latest_one_and_parseable(spark):
    from eventide.operators.sampling import latest_one
    snaps = spark.createDataFrame([("t", "h1", 1), ("t", "h2", 3), ("u", "h3", 2)],
                                  "event_type string, schema_hash string, last_seen int")
    got = {r["event_type"]: r["schema_hash"] for r in latest_one(snaps, ["event_type"], "last_seen").collect()}
    assert got == {"t": "h2", "u": "h3"}
    rows = spark.createDataFrame([('{"a":1}',), ("nope",)], "payload string")
    assert S.parseable(rows).count() == 1


def test_page_10000_parses_each_event_once(spark, tmp_path, monkeypatch):
    from eventide.plans import landed_queries as L
    days = [dt.datetime(1995, 1, 1, tzinfo=dt.UTC) + dt.timedelta(days=d) for d in range(40)]
    orders = [(k, k % 50, "OFP"[k % 3], float(k), days[k * k % 40], "5-LOW" if k % 7 == 0 else "1-URGENT") for k in range(15_000)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, f"c{k}", k % 25, 1.5, "BUILDING") for k in range(40)], "c_custkey long, c_name string, c_nationkey int, "
                          "c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        read.add(1)
        return value
    raw = L.order_records
    monkeypatch.setattr(L, "order_records", lambda *a: raw(*a).withColumn("value", counted("value")))
    got = [tuple(r) for r in L.page_10000(spark, str(tmp_path)).collect()]
    kept = sorted(((-o[4].timestamp(), f"evt_ord_{o[0]}", o[4]) for o in orders if o[5] != "5-LOW"))
    assert got == [(kept[10_000][1], kept[10_000][2].strftime("%Y-%m-%d %H:%M:%S"))]
    assert read.value == len(orders)
