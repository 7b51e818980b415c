"""TOP-5 + RT-5 selection: definition table -> latest runnable versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.model import FLOW_DEFINITIONS, RUNNABLE_STATES, FieldMapping, Flow


def definitions_table(spark: SparkSession, flows: Sequence[Flow]) -> DataFrame:
    rows = [(f.name, f.description, f.source_topic, f.destination_topic, f.version, f.state,
             [(mp.source_field, mp.destination_field, mp.conversion, mp.default_value, mp.excluded)
              for mp in f.mappings], f.dead_letter_topic) for f in flows]
    return spark.createDataFrame(rows, FLOW_DEFINITIONS)


def latest_versions(defs: DataFrame) -> DataFrame:
    """TOP-5: the highest version per name (unique (name, version))."""
    return defs.groupBy("name").agg(F.max_by(F.struct(*defs.columns), "version").alias("d")).select("d.*")


def runnable(defs: DataFrame) -> DataFrame:
    """RT-5: latest version per name whose state is ACTIVE or DRAFT."""
    return latest_versions(defs).filter(F.col("state").isin(*RUNNABLE_STATES))


def to_flows(defs: DataFrame) -> list[Flow]:
    """Compile definition rows to Flow objects on the driver.

    This reads configuration only (one row per definition), never event data.
    """
    out = []
    for r in defs.collect():
        maps = tuple(FieldMapping(x["source_field"], x["destination_field"], x["conversion"],
                                  x["default_value"], bool(x["excluded"])) for x in (r["field_mappings"] or []))
        out.append(Flow(name=r["name"], source_topic=r["source_topic"], destination_topic=r["destination_topic"],
                        mappings=maps, dead_letter_topic=r["dead_letter_topic"], version=r["version"],
                        state=r["state"], description=r["description"]))
    return out
