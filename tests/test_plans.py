"""Plan-shape checks for the scale properties the README claims."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_search_filters_reach_the_scan(spark):
    p = plan(spark, "search_type_source")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)" in p


def test_column_pruning_drops_document_text(spark):
    p = plan(spark, "document_counts")
    assert "ReadSchema: struct<lang:string,source:string>" in p


def test_latest_n_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(spark, "latest_per_type")


def test_discovery_aggregates_are_hash_based(spark):
    p = plan(spark, "discover_documents")
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_no_python_udfs_anywhere(spark):
    for name in ["flagship_route_status", "map_flatten", "discover_orders", "cosine_distance", "schema_drift"]:
        p = plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def scans(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_fan_out_reads_its_tables_once(spark):
    assert scans(spark, "fanout_counts") == 2  # orders and customer, for two definitions


def test_discovery_reads_its_table_once(spark):
    assert scans(spark, "discover_documents") == 1
    assert plan(spark, "discover_documents").split("== Optimized")[0].count("Exchange hashpartitioning") == 1


def test_discovery_runs_nothing_while_it_is_built(spark, payloads):
    import json

    from eventide.operators.discovery import discover, field_sets
    deep, paths = 1, []
    for k in range(30):
        deep = {f"k{k}": deep}
    at = "".join(f".k{k}" for k in range(29, -1, -1))[1:]
    paths = [".".join(at.split(".")[:n + 1]) for n in range(30)]
    df = payloads(json.dumps({"mixed": 1}), json.dumps({"mixed": {"a": [{"b": {"c": 1}}, 2]}}), json.dumps(deep), "[]", "3")
    spark.sparkContext.setJobGroup("build", "plans only")
    out, sets = discover(df), field_sets(df.selectExpr("1 AS g", "payload"), ["g"], count_col="n")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = ["mixed", "mixed.a", "mixed.a[*].b", "mixed.a[*].b.c", *paths]
    assert sorted(r["path"] for r in out.collect()) == sorted(want)
    got = sets.collect()[0]
    assert got["field_names"] == sorted(want) and got["n"] == 5


def test_embedding_outliers_read_twice(spark):
    assert scans(spark, "embedding_outliers") == 2


def test_alert_stats_read_stored_alerts(spark):
    assert scans(spark, "alert_stats") <= 2


def test_landing_does_not_sort_whole_rows_twice(spark):
    for name in ("land_first_wins", "land_resumed"):
        assert "SortAggregate" not in plan(spark, name) and "WindowGroupLimit" in plan(spark, name)


def test_landed_filters_reach_the_scan(spark):
    p = plan(spark, "landed_by_source")
    assert "EqualTo(source,src-3)" in p
    assert "EqualTo(status,FAILED)" in plan(spark, "landed_by_status")
    p = plan(spark, "landed_get_by_id")
    filters = p.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(id,evt_42)" in p and "received_date" in filters
