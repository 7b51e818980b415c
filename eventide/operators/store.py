"""SNK-4..8, SET-3, JN-1, FLT-11: idempotent landing and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.sources.folders import delete, names
from eventide.sources.folders import exists as folder_exists


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key by ``order`` (ascending; nulls first).

    ``row_number() = 1`` is planned with Spark's window-group limit: every map
    task keeps one row of a key before the shuffle, so a key holding a third
    of all rows costs one row per task. The input is read once (an aggregation
    of the keys alone, joined back to the rows, would parse each record twice)
    and the rows that leave are hash-partitioned by the keys, as the joins that
    follow need them.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(w)).filter(F.col("__first") == 1).drop("__first")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the last row per key by ``order`` (as above, in descending order)."""
    return first_per_key(df, keys, [o.desc_nulls_last() for o in order])


def dedup_first(events: DataFrame, order: Sequence[Column], key: str = "id") -> DataFrame:
    """SET-3: first-wins dedup by id across all topics."""
    return first_per_key(events, [key], order)


def new_rows(batch: DataFrame, existing: DataFrame | None, key: str = "id") -> DataFrame:
    """JN-1 / FLT-11: rows whose id is not stored yet (``left_anti`` on the id alone).

    Copies of an event may carry different times (an absent time defaults to
    the time of reading), so no date takes part in the match. Rows without an
    id cannot be landed once and are left out.
    """
    batch = batch.filter(F.col(key).isNotNull())
    # (a table with an index of its ids: operators/landing.py)
    return batch if existing is None else batch.join(existing.select(key), key, "left_anti")


def land(batch: DataFrame, existing: DataFrame | None, order: Sequence[Column], key: str = "id") -> DataFrame:
    """SNK-4: rows to append so that every id is stored once (first wins).

    The first copies are found first: their partitioning by id serves the anti-join.
    """
    return new_rows(dedup_first(batch.filter(F.col(key).isNotNull()), order, key), existing, key)


def exists(batch: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """FLT-11: ``left_semi`` existence filter."""
    return batch.join(existing.select(key), key, "left_semi")


def upsert(existing: DataFrame | None, updates: DataFrame, keys: Sequence[str],
           keep_on_conflict: Sequence[str] = ()) -> DataFrame:
    """SNK-5/7/8: keyed upsert as a new table image.

    Updates win; columns in ``keep_on_conflict`` keep the existing value when
    the key was already present (SNK-8 keeps ``sample_count``/``first_seen_at``).
    :class:`KeyedTable` writes it bucket by bucket (plain Parquet has no MERGE).
    """
    if existing is None:
        return updates
    both = existing.select(*updates.columns).withColumn("__new", F.lit(0)).unionByName(updates.withColumn("__new", F.lit(1)))
    if keep_on_conflict:  # a key has one old row at most
        old = Window.partitionBy(*keys)
        both = both.withColumns({c: F.coalesce(F.first(F.when(F.col("__new") == 0, F.col(c)), ignorenulls=True).over(old),
                                               F.col(c)) for c in keep_on_conflict})
    return last_per_key(both, keys, [F.col("__new")]).drop("__new")


class KeyedTable:
    """SNK-5/7/8: a table with one row per key, updated by rewriting only the buckets that updates touch.

    A version is a folder with the new contents of its buckets (hash of the
    key); a bucket's rows are those of the newest finished version that has it.
    Files of other buckets stay as they are. A version counts once its
    ``_SUCCESS`` is there, so an interrupted update changes nothing; repeated
    with the same number it replaces its own folder.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """Finished versions, ascending."""
        found = sorted(int(n[8:]) for n in names(self.spark, self.path) if n.startswith("version="))
        return [v for v in found if folder_exists(self.spark, f"{self.path}/version={v}/_SUCCESS")]

    def folders(self, before: int | None = None) -> dict[int, str]:
        """Bucket -> folder of its rows (as of the versions below ``before``)."""
        out = {}
        for v in self.versions():
            if before is None or v < before:
                for n in names(self.spark, f"{self.path}/version={v}"):
                    if n.startswith("bucket="):
                        out[int(n[7:])] = f"{self.path}/version={v}/{n}"
        return out

    def read(self, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame | None:
        """The rows (of some buckets); None while there are none."""
        found = self.folders(before)
        paths = [f for b, f in found.items() if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def upsert(self, updates: DataFrame, keep_on_conflict: Sequence[str] = (), version: int | None = None) -> int:
        """Apply ``updates`` (one row per key) as a version: the next, or the given one again. At most ``buckets`` numbers
        reach the driver."""
        version = version if version is not None else max(self.versions(), default=-1) + 1
        touched = {r[0] for r in updates.select(self.bucket()).distinct().collect()}
        image = upsert(self.read(touched, version), updates, self.keys, keep_on_conflict)
        (image.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite")
         .partitionBy("bucket").parquet(f"{self.path}/version={version}"))
        return version

    def vacuum(self) -> None:
        """Delete what no bucket is read from any more, but the last version's predecessors that a replay would read."""
        versions = self.versions()
        if len(versions) < 2:
            return
        used = {*self.folders().values(), *self.folders(versions[-1]).values()}
        for v in versions[:-1]:
            found = [f"{self.path}/version={v}/{n}" for n in names(self.spark, f"{self.path}/version={v}") if n.startswith("bucket=")]
            for f in found:
                if f not in used:
                    delete(self.spark, f)
            if found and not used.intersection(found):
                delete(self.spark, f"{self.path}/version={v}")
