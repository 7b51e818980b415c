"""RT-1..6: route mapped events to destination / dead-letter topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.model import RAW_TOPIC, Flow
from eventide.operators.envelope import envelope_json, parse_envelopes, serialize
from eventide.operators.mapping import apply_flow, compile_mappings


def transform(records: DataFrame, flow: Flow, value_col: str = "value") -> DataFrame:
    """Parse (once) and map one flow's source records; keeps key/topic columns."""
    return apply_flow(parse_envelopes(records, value_col), flow)


def route(transformed: DataFrame, flow: Flow) -> DataFrame:
    """RT-1/3/4 + SNK-2/3 as one outbox: ``(topic, key, value, ok)``.

    Success iff parsed and not FAILED -> destination; everything else -> the
    definition's dead-letter topic; unparseable records keep their raw text.
    The key is carried unchanged.
    """
    ok = F.col("parse_ok") & (F.coalesce(F.col("status"), F.lit("")) != "FAILED")
    out = serialize(transformed, "__envelope")
    key = F.col("key") if "key" in transformed.columns else F.col("id")
    carry = [c for c in ("partition", "offset") if c in transformed.columns]
    return out.select(
        F.when(ok, F.lit(flow.destination_topic)).otherwise(F.lit(flow.dead_letter)).alias("topic"),
        key.alias("key"),
        F.when(F.col("parse_ok"), F.col("__envelope")).otherwise(F.col("raw")).alias("value"),
        ok.alias("ok"),
        F.lit(flow.name).alias("flow"),
        *[F.col(c).alias(f"source_{c}") for c in carry],
    )


def split(transformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """RT-1 as two DataFrames (persist the input first when both are written)."""
    ok = F.col("parse_ok") & (F.coalesce(F.col("status"), F.lit("")) != "FAILED")
    return transformed.filter(ok), transformed.filter(~ok)


def dead_letter_rows(transformed: DataFrame) -> DataFrame:
    """RT-6: failures in the ``dead_letter_events`` shape."""
    failed = transformed.filter(~(F.col("parse_ok") & (F.col("status") != "FAILED")))
    return failed.select(
        F.col("id"), F.col("flow").alias("pipeline_name"),
        F.col("type").alias("event_type"), F.col("source").alias("event_source"),
        F.when(F.col("parse_ok"), F.to_json(F.col("payload"))).otherwise(F.col("raw")).alias("event_payload"),
        F.col("error_message"), F.lit(0).alias("retry_count"))


def fan_out(records: DataFrame, flows: Sequence[Flow], topic_col: str = "topic",
            value_col: str = "value") -> DataFrame:
    """RT-5: every runnable definition reads its own source topic, in one read of the records.

    ``flows`` is configuration (one entry per definition, compiled on the
    driver). A record is parsed once; each definition of its topic maps the
    parsed payload (others map NULL) and adds one outbox row, spread at the
    end by one ``inline``. Neither scans nor parses grow with the number of
    definitions, and nothing is shuffled.
    """
    live = [fl for fl in flows if fl.runnable]
    if not live:
        raise ValueError("no runnable definitions")
    src = records.filter(F.col(topic_col).isin(*sorted({fl.source_topic for fl in live})))
    if topic_col != "topic" and "topic" in src.columns:
        src = src.drop("topic")
    env = parse_envelopes(src.withColumnRenamed(topic_col, "__topic"), value_col)
    key = F.col("key") if "key" in env.columns else F.col("id")
    carry = [c for c in ("partition", "offset") if c in env.columns]
    rows = []
    for i, fl in enumerate(live):
        mine = F.col("__topic") == fl.source_topic
        env = env.withColumn("__in", F.when(mine & F.col("parse_ok"), F.col("payload")))
        env = compile_mappings(env, fl.mappings, "__in", f"__mapped{i}", f"__error{i}").drop("__in")
        error = F.col(f"__error{i}")
        ok = F.col("parse_ok") & error.isNull()
        body = envelope_json(
            F.when(ok, F.col(f"__mapped{i}")).otherwise(F.col("payload")),
            F.when(ok, F.lit("PROCESSED")).otherwise(F.lit("FAILED")),
            F.when(ok, F.col("error_message")).otherwise(F.concat(F.lit(f"[{fl.name}] "), error)),
            F.current_timestamp())
        rows.append(F.when(mine, F.struct(
            F.when(ok, F.lit(fl.destination_topic)).otherwise(F.lit(fl.dead_letter)).alias("topic"),
            key.alias("key"),
            F.when(F.col("parse_ok"), body).otherwise(F.col("raw")).alias("value"),
            ok.alias("ok"), F.lit(fl.name).alias("flow"),
            *[F.col(c).alias(f"source_{c}") for c in carry])))
    return env.select(F.inline(F.array_compact(F.array(*rows))))


def publish(envelopes: DataFrame, topic: str = RAW_TOPIC) -> DataFrame:
    """SNK-1: new envelopes as outbox rows keyed by event id on the raw topic.

    Persist the envelopes first when they are written more than once: ids and
    times are generated (``uuid()``, ``current_timestamp()``) per evaluation.
    """
    out = serialize(envelopes, "__envelope")
    return out.select(F.lit(topic).alias("topic"), F.col("id").alias("key"),
                      F.col("__envelope").alias("value"), F.lit(True).alias("ok"),
                      F.lit(None).cast("string").alias("flow"))
