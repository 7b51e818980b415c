"""Small tables that live detectors keep between checks.

A state table has a folder per run and batch (see ``jobs``). A batch reads the
last finished folder of every run (of its own run: the last before it) and
writes the next, so a check reads the state and its new rows, never the event
history; a replayed batch starts from the same folder and writes the same one. A
query with a new checkpoint goes on from what earlier runs left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.sampling import latest_n
from eventide.sources.folders import delete, exists, names

#: Finished batches that a run's state keeps (the one before the last serves a replay of the last).
KEPT_BATCHES = 2


def last_folders(spark: SparkSession, path: str, run: str, batch: int) -> dict[str, str]:
    """Run -> folder of its last finished batch; of ``run`` itself the last before ``batch``."""
    out = {}
    for r in names(spark, path):
        if not r.startswith("run="):
            continue
        done = sorted(int(b[6:]) for b in names(spark, f"{path}/{r}") if b.startswith("batch="))
        done = [b for b in done if (r[4:] != run or b < batch) and exists(spark, f"{path}/{r}/batch={b}/_SUCCESS")]
        if done:
            out[r[4:]] = f"{path}/{r}/batch={done[-1]}"
    return out


def write_state(df: DataFrame, path: str, run: str, batch: int) -> DataFrame:
    """Write a batch's state, drop folders that no replay needs, and return the state as written."""
    spark = df.sparkSession
    own = f"{path}/run={run}/batch={batch}"
    df.write.mode("overwrite").parquet(own)
    for old in sorted(int(b[6:]) for b in names(spark, f"{path}/run={run}") if b.startswith("batch="))[:-KEPT_BATCHES]:
        delete(spark, f"{path}/run={run}/batch={old}")
    return spark.read.schema(df.schema).parquet(own)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- counts of a trailing window

def second_counts(events: DataFrame) -> DataFrame:
    """Events per (type, source, second): ``second`` is the time rounded up to a whole second, ``n_at`` of the ``n``
    lie exactly on it (so that a window with both ends inclusive is a sum of seconds)."""
    part = "pmod(unix_micros(received_at), 1000000L)"  # micros beyond the whole second before
    second = F.expr(f"(unix_micros(received_at) - {part}) div 1000000 + int({part} > 0)")
    return (events.filter(F.col("received_at").isNotNull())
            .groupBy("type", "source", second.alias("second"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(f"{part} = 0")).alias("n_at"))
            .withColumn("hour", F.expr("(second - pmod(second, 3600L)) div 3600")))


class TrailingCounts:
    """Stored counts of all events a job has read: a folder per hour, in it one per run and batch."""

    SCHEMA = "type string, source string, second long, n long, n_at long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, events: DataFrame, run: str, batch: int) -> None:
        """The counts of a batch; replayed, it replaces its own folders (the same hours) and no others.

        An hour, of at most 3600 counts a type and source, is written by one task: a file an hour, and the hours in
        parallel (a number of tasks that is given is not coalesced).
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (second_counts(events).repartition(tasks, "hour").withColumns({"run": F.lit(run), "batch": F.lit(batch)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("hour", "run", "batch").parquet(self.path))

    def window(self, end: int, seconds: int) -> DataFrame:
        """Events per (event_type, event_source) from ``end - seconds`` to ``end`` (epoch seconds, both inclusive): lists and
        reads the folders of the window's hours only."""
        start = end - seconds
        folders = [f"{self.path}/hour={h}" for h in range(start // 3600, end // 3600 + 1)]
        folders = [f for f in folders if exists(self.spark, f)]
        read = self.spark.read.option("basePath", self.path).schema(self.SCHEMA)
        rows = read.parquet(*folders) if folders else self.spark.createDataFrame([], self.SCHEMA)
        rows = rows.filter(F.col("second").between(start, end))
        counted = F.when(F.col("second") == start, F.col("n_at")).otherwise(F.col("n"))
        out = rows.groupBy(F.col("type").alias("event_type"), F.col("source").alias("event_source")).agg(
            F.sum(counted).alias("event_count"))
        return out.filter(F.col("event_count") > 0)


# --- history of the counts

KEYS = ["event_type", "event_source"]


def moments(counts: DataFrame) -> DataFrame:
    """Exact sums of ``event_count`` per key: n, s, ss."""
    c = F.col("event_count").cast("decimal(19,0)")
    return counts.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum(c).cast("decimal(38,0)").alias("s"),
                                     F.sum(c * c).cast("decimal(38,0)").alias("ss"))


def add_moments(parts: list[DataFrame]) -> DataFrame:
    return _union(parts).groupBy(*KEYS).agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("ss").cast("decimal(38,0)").alias("ss"))


def history(sums: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each key from its sums."""
    n, s, ss = (F.col(c).cast("decimal(38,0)") for c in ("n", "s", "ss"))
    spread = (n * ss - s * s).cast("double") / (F.col("n") * (F.col("n") - 1))
    return sums.select(*KEYS, (F.col("s").cast("double") / F.col("n")).alias("h_avg"),
                       F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("h_std"))


def past_moments(spark: SparkSession, baselines: str, run: str, batch: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(of this run, of all other runs) before this batch: from the kept sums, or from the baseline rows of runs without."""
    path = f"{baselines.rstrip('/')}_moments"
    kept = last_folders(spark, path, run, batch)
    rest = {r: f for r, f in last_folders(spark, baselines.rstrip("/"), run, batch).items() if r not in kept}
    found: dict[bool, list[DataFrame]] = {True: [], False: []}
    for r, folder in kept.items():
        found[r == run].append(spark.read.parquet(folder))
    for r in rest:
        rows = spark.read.parquet(f"{baselines.rstrip('/')}/run={r}")
        found[r == run].append(moments(rows.filter(F.col("batch") < batch) if r == run else rows))
    return tuple(add_moments(found[k]) if found[k] else None for k in (True, False))


# --- latest rows of each type

class LatestRows:
    """The latest ``n`` rows of each type: a bounded sample that grows with the number of types, not of events."""

    def __init__(self, spark: SparkSession, path: str, n: int, order: str = "stored_at"):
        self.spark, self.path, self.n, self.order = spark, path.rstrip("/"), n, order

    def update(self, rows: DataFrame, run: str, batch: int, seed: DataFrame | None = None) -> DataFrame:
        """The latest rows after ``rows`` (with id, type and the order column); ``seed`` stands in for the past where there is none."""
        past = [self.spark.read.schema(rows.schema).parquet(f) for f in last_folders(self.spark, self.path, run, batch).values()]
        if not past and seed is not None:
            past = [seed.select(*rows.columns)]
        order = [F.col(self.order).desc(), F.col("id").desc()]
        new = latest_n(rows, ["type"], order, self.n)
        both = _union([*past, new])
        if past:  # of an event that several runs have kept, one row
            both = both.dropDuplicates(["type", "id", self.order])
        return write_state(latest_n(both, ["type"], order, self.n), self.path, run, batch)
