"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import checkpoint_dir

#: Rows of one Arrow batch handed to a Python worker (bounds worker memory; not a limit on rows).
ARROW_ROWS = 1000
#: Bytes of one Arrow batch.
ARROW_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given directory, as its files split it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark hand Python workers small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (bytes.split() splits at exactly these six bytes)."""
    return text.split()


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                      schema=schema)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut a partition sorted by integer ``keys`` into tables of whole key runs.

    Yields (table, starts): the rows and the first row of each run. A run that
    reaches the end of a batch waits for the next one, so a run is never cut.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is None or any(c[0] != x for c, x in zip(cols, last, strict=True))
        last = [c[-1] for c in cols]
        at = np.flatnonzero(new)
        if not len(at):
            held.append(b)
            continue
        cut = int(at[-1])
        if held or cut:
            yield _table([*held, b.slice(0, cut)], keys)
        held = [b.slice(cut)]
    if held:
        yield _table(held, keys)


def _table(parts: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    t = pa.Table.from_batches(parts).combine_chunks()
    new = np.zeros(t.num_rows, bool)
    for k in keys:
        c = t.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    if len(new):
        new[0] = True
    return t, np.flatnonzero(new)


def one_row_per_key(docs: DataFrame, columns: list[str], many: DataFrame) -> DataFrame:
    """One row of each key (``columns``, not null). ``many`` holds the keys that may repeat; other rows are not shuffled."""
    same = [docs[c] == many[m] for c, m in zip(columns, many.columns, strict=True)]
    return docs.join(many, same, "left_anti").unionByName(docs.join(many, same, "left_semi").dropDuplicates(columns))


def apart(docs: DataFrame, names: set[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` without columns called like one of ``names`` (they get unused names), and its columns under their own names.

    An operator that works with columns of ``names`` neither reads nor changes
    columns of its input that happen to be called so.
    """
    taken = {c.lower() for c in docs.columns} | {n.lower() for n in names}
    new = []
    for c in docs.columns:
        unused = c
        while unused.lower() in {n.lower() for n in names} or (unused != c and unused.lower() in taken):
            unused = f"{unused}_in"
        taken.add(unused.lower())
        new.append(unused)
    back = [F.col(f"`{n}`").alias(c) for n, c in zip(new, docs.columns)]
    return docs.toDF(*new), back
