import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from eventide.functions.vectors import centroids, cosine_similarity
from eventide.operators import alerts as A
from eventide.operators.detect import embedding as EMB
from eventide.operators.detect import statistical as ST


def sim(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    return df.select(cosine_similarity(F.col("a"), F.col("b"))).first()[0]


def test_cosine(spark):
    assert sim(spark, [1.0, 2.0], [1.0, 2.0]) == pytest.approx(1.0)
    assert sim(spark, [1.0, 0.0], [0.0, 1.0]) == pytest.approx(0.0)
    assert sim(spark, [1.0, 1.0], [-1.0, -1.0]) == pytest.approx(-1.0)
    assert sim(spark, [1.0, 2.0, 3.0], [1.1, 2.0, 3.1]) > 0.99
    assert sim(spark, [0.0, 0.0], [1.0, 1.0]) == 0.0
    assert sim(spark, [1.0], [1.0, 2.0]) is None


def test_centroids(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [1.0, 1.0]), ("c", [1.0]), ("c", [1.0, 2.0])],
                               "type string, vector array<double>")
    c = {r["type"]: (r["centroid"], r["dims_ok"]) for r in centroids(df).collect()}
    assert c["a"] == ([2.0, 3.0], True) and c["b"] == ([1.0, 1.0], True) and not c["c"][1]


def test_outlier_flow(spark):
    rows = [(f"n{i}", "t", [1.0, 0.01 * i], i) for i in range(5)] + [("x", "t", [-1.0, 0.0], 9),
                                                                     ("y", "u", [1.0, 0.0], 1), ("z", "u", [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "id string, type string, vector array<double>, seq long")
    d = {r["id"]: r["distance"] for r in EMB.distances(df).collect()}
    assert "y" not in d  # type u has fewer than 3 events
    out = EMB.outliers(df, threshold=0.85).collect()
    assert [r["event_id"] for r in out] == ["x"] and out[0]["severity"] == "LOW"
    assert out[0]["description"].startswith("Event x has unusual content for type t (distance: ")


def _alerts(spark):
    rows = [("STATISTICAL", "HIGH", "a", "s", None, "t1"), ("SCHEMA_DRIFT", "MEDIUM", "a", None, None, "t2"),
            ("EMBEDDING", "LOW", "b", None, "e1", "t3")]
    df = spark.createDataFrame(rows, "detector_type string, severity string, event_type string, event_source string, "
                                     "event_id string, title string")
    return A.to_alerts(df, ["event_type", "event_id", "title"])


def test_alerts(spark):
    al = _alerts(spark)
    ids = [r["id"] for r in al.orderBy("title").collect()]
    res = spark.createDataFrame([(ids[0],), ("missing",)], "id string")
    new, unknown = A.resolve(al, res)
    st = A.alert_stats(new).first()
    assert (st["total"], st["open"], st["resolved"]) == (3, 2, 1)
    assert [r[0] for r in unknown.collect()] == ["missing"]
    assert A.filter_alerts(new, severity="LOW", event_type="a").count() == 1
    assert A.filter_alerts(new, event_type="a", resolved=True).count() == 2
    assert A.filter_alerts(new, resolved=True).count() == 1


def _volume_events(spark, counts):
    rows, k = [], 0
    for day, n in enumerate(counts):
        for i in range(n):
            rows.append((f"e{k}", "click", "web", dt.datetime(2024, 1, 1 + day, 0, 0, 0) + dt.timedelta(seconds=i)))
            k += 1
    return spark.createDataFrame(rows, "id string, type string, source string, received_at timestamp")


def test_volume_replay(spark):
    ev = _volume_events(spark, [20, 21, 19, 20, 80, 20, 3])
    base, alerts = ST.detect_volume(ev, "1 day")
    b = base.orderBy("window_start").collect()
    assert b[0]["avg_count"] is None and b[1]["avg_count"] is None and b[2]["avg_count"] == pytest.approx(20.5)
    a = alerts.orderBy("window_start").collect()
    assert [(x["severity"], x["event_count"]) for x in a] == [("HIGH", 80)]
    assert a[0]["description"].startswith("click events from web: 80 events in last 1440 min (avg: 20, z-score:")


def test_volume_drop_and_live_agrees(spark):
    ev = _volume_events(spark, [100, 102, 98, 100, 20, 25])
    _, alerts = ST.detect_volume(ev, "1 day")
    got = [(x["severity"], x["event_count"]) for x in alerts.orderBy("window_start").collect()]
    assert got == [("MEDIUM", 20), ("MEDIUM", 25)]
    # live form on a fixed clock: history = the first five daily baselines
    hist = ST.baselines(ST.window_counts(ev.filter(F.col("received_at") < "2024-01-06"), "1 day"))
    as_of = dt.datetime(2024, 1, 6, 0, 5, 0)
    base, live = ST.live_check(ev, hist, as_of, window_minutes=1440)
    assert [(x["severity"], x["event_count"]) for x in live.collect()] == [("MEDIUM", 25)]
    assert base.first()["avg_count"] == pytest.approx(84.0)
    assert math.isclose(base.first()["stddev_count"], hist.agg(F.stddev_samp("event_count")).first()[0])
