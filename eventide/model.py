"""Data model: envelope, mapping definitions and the fixed table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference behaviour.
# ---------------------------------------------------------------------------
STATUS_VALUES = ("RECEIVED", "ROUTED", "PROCESSED", "FAILED")
ENVELOPE_KEYS = ("id", "type", "source", "timestamp", "payload", "metadata",
                 "status", "errorMessage", "processedAt")
CONVERSIONS = ("NONE", "TO_STRING", "TO_INTEGER", "TO_LONG", "TO_DOUBLE",
               "TO_BOOLEAN", "TO_TIMESTAMP", "TO_UPPER", "TO_LOWER", "MASK",
               "FLATTEN")
DEFINITION_STATES = ("DRAFT", "ACTIVE", "PAUSED", "DEPLOYING")
RUNNABLE_STATES = ("ACTIVE", "DRAFT")
DEFAULT_DEAD_LETTER_TOPIC = "events.failed"
RAW_TOPIC = "events.raw"
ID_PREFIX = "evt_"
NOW_TOKEN = "${now}"
UUID_TOKEN = "${uuid}"
MAX_BATCH = 500
SAMPLE_CAP = 100
DISCOVERY_SAMPLE = 10
PAGE_SIZE = 50
WINDOW_MINUTES = 5
SPIKE_Z = 3.0
DROP_RATIO = 0.3
MIN_EVENTS = 10
SCHEMA_SAMPLE = 20
EMBED_BATCH = 20
EMBED_THRESHOLD = 0.85
EMBED_MIN_EVENTS = 3


@dataclass(frozen=True)
class FieldMapping:
    source_field: str | None
    destination_field: str | None
    conversion: str | None = None
    default_value: str | None = None
    excluded: bool = False
    format: str | None = None  # stored, never read (as in the reference)

    def __post_init__(self):
        if self.conversion is not None and self.conversion not in CONVERSIONS:
            raise ValueError(f"unknown conversion {self.conversion!r}")


@dataclass(frozen=True)
class Flow:
    """A mapping definition: source topic -> mappings -> destination topic."""
    name: str
    source_topic: str
    destination_topic: str
    mappings: Sequence[FieldMapping] = field(default_factory=tuple)
    dead_letter_topic: str | None = None
    version: int = 1
    state: str = "DRAFT"
    description: str | None = None

    @property
    def dead_letter(self) -> str:
        """RT-4: the definition's dead-letter topic, else the default."""
        return self.dead_letter_topic or DEFAULT_DEAD_LETTER_TOPIC

    @property
    def runnable(self) -> bool:
        return self.state in RUNNABLE_STATES


def m(src, dst, conversion=None, default=None, excluded=False) -> FieldMapping:
    """Short constructor for mapping lists."""
    return FieldMapping(src, dst, conversion, default, excluded)


# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------
STORED_EVENTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("stored_at", T.TimestampType()),
])

EVENT_BASELINES = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_source", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("avg_count", T.DoubleType()),
    T.StructField("stddev_count", T.DoubleType()),
])

SCHEMA_SNAPSHOTS = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("schema_hash", T.StringType()),
    T.StructField("field_names", T.ArrayType(T.StringType())),
    T.StructField("sample_count", T.IntegerType()),
    T.StructField("first_seen_at", T.TimestampType()),
    T.StructField("last_seen_at", T.TimestampType()),
])

ANOMALY_ALERTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("detector_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_source", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("resolved", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
])

MAPPING_STRUCT = T.StructType([
    T.StructField("source_field", T.StringType()),
    T.StructField("destination_field", T.StringType()),
    T.StructField("conversion", T.StringType()),
    T.StructField("default_value", T.StringType()),
    T.StructField("excluded", T.BooleanType()),
])

FLOW_DEFINITIONS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("destination_topic", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("state", T.StringType()),
    T.StructField("field_mappings", T.ArrayType(MAPPING_STRUCT)),
    T.StructField("dead_letter_topic", T.StringType()),
])
