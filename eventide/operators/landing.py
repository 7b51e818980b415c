"""SNK-4, JN-1, STR-2, SET-3, FLT-7: landing every event once, by an index of ids.

The event table is laid out by run, batch and ``received_date`` (time-range
searches prune by date). Beside it lies the index of its ids: (id,
received_date), partitioned by hash bucket, with Parquet Bloom filters on id. A
batch asks the index about its own buckets only (a static partition filter), so
landing reads no event and none of the other buckets; a lookup by id reads one
bucket, then one date of the table. Index rows are a set: a row that is there
twice does no harm.

A batch writes its events, then its index entries, each into a folder of its run
and batch with overwrite; a replayed batch leaves its own entries out of the
question and replaces both. Entries that a run could not write before it ended
for good are added by :meth:`IdIndex.sync`. Batches are numbered in order within
a run, so a run's entries reach up to its greatest batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators import store as STO
from eventide.sources.folders import delete, exists, names

#: Buckets of a new index. A batch of fewer ids than buckets reads a part of them; more buckets are more files a batch
#: (merged by :meth:`IdIndex.merge`). A table of 1e11 events has 25 million ids a bucket at 4096.
ID_BUCKETS = 512
#: Ends the name of a run whose entries were merged.
MERGED = "~merged"
#: Bloom filters on id, of the size that a file's ids need: of fixed size (1 MB) they outweigh the rows of a small file.
BLOOM = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true",
         "parquet.bloom.filter.candidates.number#id": "14"}


class IdIndex:
    """The ids of a landed table, at ``path``. The number of buckets is fixed when the index is first written."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = ID_BUCKETS):
        self.spark, self.root = spark, path.rstrip("/")
        found = [n for n in names(spark, self.root) if n.startswith("buckets=")]
        self.buckets = int(found[0].partition("=")[2]) if found else buckets
        self.path = f"{self.root}/buckets={self.buckets}"

    @classmethod
    def beside(cls, spark: SparkSession, table_path: str, buckets: int = ID_BUCKETS) -> IdIndex:
        return cls(spark, f"{table_path.rstrip('/')}_ids", buckets)

    def bucket(self, key: str = "id") -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame | None:
        """All entries: id, received_date, run, batch, id_bucket; None while there are none."""
        if not exists(self.spark, self.path):
            return None
        return self.spark.read.option("basePath", self.path).schema(
            "id string, received_date date, run string, batch long, id_bucket int").parquet(self.path)

    def of(self, ids: DataFrame, key: str = "id", run: str | None = None, batch: int | None = None) -> DataFrame | None:
        """Entries in the buckets of ``ids``, but for those of this run and batch.

        At most ``buckets`` numbers reach the driver; they become a partition filter.
        """
        entries = self.read()
        if entries is None:
            return None
        wanted = [r[0] for r in ids.filter(F.col(key).isNotNull()).select(self.bucket(key)).distinct().collect()]
        entries = entries.filter(F.col("id_bucket").isin(wanted) if wanted else F.lit(False))
        if run is not None:
            entries = entries.filter(~((F.col("run") == run) & (F.col("batch") == batch)))
        return entries

    def find(self, id_value: str) -> DataFrame:
        """received_date of an id: one bucket, its row groups pruned by the Bloom filter."""
        one = self.spark.range(1).select(F.lit(id_value).alias("id")).select(self.bucket()).first()[0]
        entries = self.read()
        if entries is None:
            return self.spark.createDataFrame([], "received_date date")
        return entries.filter((F.col("id_bucket") == one) & (F.col("id") == id_value)).select("received_date").distinct()

    def write(self, rows: DataFrame, run: str, batch: int) -> None:
        """Entries (id, received_date) of a batch, a file per bucket."""
        out = rows.select("id", "received_date", self.bucket().alias("id_bucket"))
        (out.repartition("id_bucket").sortWithinPartitions("id_bucket", "id").write.mode("overwrite")
         .options(**BLOOM).partitionBy("id_bucket").parquet(f"{self.path}/run={run}/batch={batch}"))

    def _batches(self, path: str) -> dict[str, list[int]]:
        """Batches of each run below ``path``, ascending."""
        runs = [n for n in names(self.spark, path) if n.startswith("run=")]
        return {r[4:]: sorted(int(b[6:]) for b in names(self.spark, f"{path}/{r}") if b.startswith("batch=")) for r in runs}

    def sync(self, table_path: str) -> None:
        """Add the entries of the table's batches that have none (a run that ended between its two writes, an older table)."""
        done = self._batches(self.path)
        for run, batches in self._batches(table_path.rstrip("/")).items():
            upto = max([*done.get(run, []), *done.get(run + MERGED, []), -1])
            for b in batches:
                if b > upto:
                    folder = f"{table_path.rstrip('/')}/run={run}/batch={b}"
                    self.write(self.spark.read.schema("id string, received_date date").parquet(folder), run, b)

    def merge(self) -> None:
        """Rewrite the entries of all batches that cannot be replayed any more (all but the last of each run) as one
        folder per run, a file per bucket. Run it between batches; an interruption leaves entries twice, none lost."""
        for run, batches in self._batches(self.path).items():
            old = batches[:-1]
            if run.endswith(MERGED) or not old:
                continue
            earlier = self._batches(self.path).get(run + MERGED, [])
            entries = self.read().filter(F.col("run").isin(run, run + MERGED) & (F.col("batch") <= old[-1]))
            self.write(entries.select("id", "received_date").distinct(), run + MERGED, old[-1])
            for r, bs in ((run, old), (run + MERGED, [b for b in earlier if b != old[-1]])):
                for b in bs:
                    delete(self.spark, f"{self.path}/run={r}/batch={b}")


def land_batch(spark: SparkSession, rows: DataFrame, table_path: str, order: Sequence[Column], run: str, batch: int,
               index: IdIndex | None = None, drop: Sequence[str] = ()) -> None:
    """Land the events of a batch that the table does not hold yet; of copies in the batch the first by ``order``.

    ``rows`` has ``id`` and ``received_at`` and is read more than once: persist it where that is dear. Columns named in
    ``drop`` (those of the order) are not stored.
    """
    index = index or IdIndex.beside(spark, table_path)
    rows = rows.withColumn("received_date", F.to_date("received_at"))
    first = STO.dedup_first(rows.filter(F.col("id").isNotNull()), order)
    known = index.of(rows, run=run, batch=batch)
    new = first if known is None else first.join(known.select("id"), "id", "left_anti")
    own = f"{table_path.rstrip('/')}/run={run}/batch={batch}"
    # rows of a date meet in a task (a large date in several), so a batch has about a file a date and not one a task and date
    (new.drop(*drop).hint("rebalance", "received_date").write.mode("overwrite").options(**BLOOM)
     .partitionBy("received_date").parquet(own))
    index.write(spark.read.schema("id string, received_date date").parquet(own), run, batch)


def find_event(spark: SparkSession, table_path: str, id_value: str, index: IdIndex | None = None) -> DataFrame:
    """FLT-7: the event of an id: the index names its date (one row to the driver), the table is pruned to it."""
    index = index or IdIndex.beside(spark, table_path)
    dates = [r[0] for r in index.find(id_value).collect()]
    table = spark.read.parquet(table_path)
    # a landed id has one date; entries without a date (no received_at) are found under the null date
    where = F.col("received_date").isin([d for d in dates if d is not None]) if any(dates) else F.lit(False)
    if None in dates:
        where = where | F.col("received_date").isNull()
    return table.filter(where & (F.col("id") == id_value))
