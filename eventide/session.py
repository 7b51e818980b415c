"""Session settings every operator relies on.

* UTC session time zone: envelope times are offsets, stored as UTC instants.
* Duplicate JSON keys resolve last-wins (as a JSON tree does), both in
  ``parse_json`` and in ``map_concat`` (used by FLATTEN).
* AQE on: partition coalescing, skew-join splitting and runtime broadcast
  conversion (a size-checked broadcast; the sort-merge plan stays the fallback).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change results; applied to any session we are handed.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Settings that only change the physical plan.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM compiles no method of more bytecodes; a longer fused one would be interpreted for every row.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in TUNING_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "eventide", driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster, ``master`` and the checkpoint directory come from the
    submit configuration; locally (tests, bench) we fill in defaults.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**REQUIRED_CONF, **TUNING_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # local mode runs every task in the driver JVM: its heap is the executor memory
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session without one gets a scratch folder (tests, bench); on
    a cluster executors could not see it, so its absence is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
