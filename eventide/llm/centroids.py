"""Centroid clustering over space-filling-curve zone maps.

Vectors become whole numbers, are laid out along a Hilbert curve and cut into
blocks of neighbours. A block carries its zone map (smallest and largest
component per dimension, component sums, row count). In a round, bounds on the
distances between a block's box and the centroids leave the block's candidate
centroids: one candidate settles the block from its zone map alone; otherwise
its vectors are compared exactly with the candidates only.

The blocks are written once to the shared folder; every round is one narrow
pass over them that returns a row per cluster and task, so a round moves no
vectors and the driver sees k rows of sums. Vectors are range-partitioned by
(curve key, id hash): equal vectors and equal ids spread over many blocks.

Defined results: rows whose vector is null, has another number of components,
or holds a null, NaN or infinite component are left out; a null id is kept and
hashed as the empty text; repeated rows are so many vectors; of equal distances
the smaller centroid number wins; with fewer than k vectors there are as many
centroids as vectors; an empty table gives no rows. Distances must fit 64 bits,
so components beyond +-2^27 after scaling are held at that bound. Only the id
and the vector column are read: other columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import bounded_batches, shuffle_partitions
from eventide.session import checkpoint_dir

#: Vectors of a block.
BLOCK = 512
#: Bits per dimension of the curve key.
CURVE_BITS = 3
#: Bound of a scaled component: 64-bit distances of up to 64 components cannot overflow.
MAX_COMPONENT = 1 << 27
#: Below this bound sums of 64 products are exact in double precision (matrix product).
EXACT_DOUBLE = 1 << 21

BLOCK_SCHEMA = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("valid", pa.binary()), ("vectors", pa.binary()),
                          ("lo", pa.binary()), ("hi", pa.binary()), ("sums", pa.binary())])
BLOCK_DDL = "n int, ids binary, valid binary, vectors binary, lo binary, hi binary, sums binary"


def hilbert_keys(x: np.ndarray, bits: int = CURVE_BITS) -> list[bytes]:
    """Place on the Hilbert curve of each row of ``x`` (whole numbers of ``bits`` bits per column), as bytes in curve order."""
    axes = np.ascontiguousarray(x.T).astype(np.uint32)
    dims = len(axes)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level
        p = np.uint32(q - 1)
        for i in range(dims):
            flip = (axes[i] & np.uint32(q)) != 0
            swap = np.where(flip, np.uint32(0), (axes[0] ^ axes[i]) & p)
            axes[0] ^= np.where(flip, p, np.uint32(0)) ^ swap
            axes[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((axes[-1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    axes ^= turn
    planes = [(axes >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]  # highest bits first
    packed = np.packbits(np.concatenate(planes).astype(np.uint8), axis=0).T
    return [row.tobytes() for row in np.ascontiguousarray(packed)]


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact, one column per centroid."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if top <= EXACT_DOUBLE:
        xf, cf = x.astype(np.float64), centroids.astype(np.float64)
        d = (xf * xf).sum(1)[:, None] - 2.0 * (xf @ cf.T) + (cf * cf).sum(1)
        return d.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector of the box, ascending.

    First by the least and greatest distance of the box to each centroid, then
    against the centroid ``best`` of the smallest greatest distance: over the box,
    d(x, best) - d(x, c) is linear in x, so its largest value is known; where it
    is below zero c never wins. Double precision is used with a margin, which can only keep more candidates.
    """
    lo, hi, c = lo.astype(np.float64), hi.astype(np.float64), centroids.astype(np.float64)
    near = (np.maximum(np.maximum(lo - c, c - hi), 0.0) ** 2).sum(1)
    far = (np.maximum(np.abs(lo - c), np.abs(hi - c)) ** 2).sum(1)
    best = int(np.argmin(far))
    left = near <= far[best] * (1 + 1e-9)
    step = 2.0 * (c - c[best])
    most = (c[best] ** 2).sum() - (c ** 2).sum(1) + np.where(step > 0, step * hi, step * lo).sum(1)
    size = (np.abs(step) * np.maximum(np.abs(lo), np.abs(hi))).sum(1) + (c ** 2).sum(1) + (c[best] ** 2).sum()
    left &= ~(most < -1e-9 * size)
    left[best] = True
    return np.flatnonzero(left)


def assign_block(b: dict, centroids: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of a block, their clusters among the candidates ``picks`` and squared distances."""
    x = np.frombuffer(b["vectors"], "<i4").reshape(-1, centroids.shape[1]).astype(np.int64)
    d = distances(x, centroids[picks])
    at = d.argmin(1)  # the first of equal distances: the smallest number
    return x, picks[at], d[np.arange(len(x)), at]


def _kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    v = F.col(vector_col)
    good = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(v.isNotNull() & good).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda x: F.greatest(F.lit(-MAX_COMPONENT), F.least(F.lit(MAX_COMPONENT), F.floor(
            F.greatest(F.lit(-1e9), F.least(F.lit(1e9), x.cast("double"))) * 1024.0))).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of the smallest sha256 of ``<seed>:<id>`` (ties: the smaller vector)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def write_blocks(kept: DataFrame, path: str, dims: int, block: int = BLOCK) -> None:
    """Vectors in Hilbert order as blocks with zone maps, a table at ``path``.

    The curve's cells span the range of all components (one aggregation).
    """
    spark = kept.sparkSession
    span = kept.select(F.array_min("v").alias("a"), F.array_max("v").alias("b")).agg(F.min("a"), F.max("b")).first()
    low, high = (span[0], span[1]) if span[0] is not None else (0, 0)
    cells = 1 << CURVE_BITS

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, dims).astype(np.int64)
            cell = (x - low) * cells // (high - low + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(hilbert_keys(cell), pa.binary()),
                 pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())], ["id", "curve", "v"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        rows: list[bytes] = []

        def close() -> pa.RecordBatch:
            data = b"".join(rows)
            x = np.frombuffer(data, "<i4").reshape(-1, dims)
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip([
                len(rows), np.array([i or 0 for i in ids], "<i8").tobytes(), bytes(i is not None for i in ids), data,
                x.min(0).tobytes(), x.max(0).tobytes(), x.sum(0, dtype=np.int64).tobytes()], BLOCK_SCHEMA)],
                schema=BLOCK_SCHEMA)
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                rows.append(v)
                if len(rows) == block:
                    yield close()
                    ids, rows = [], []
        if rows:
            yield close()

    placed = kept.mapInArrow(keys, "id long, curve binary, v binary")
    order = [F.col("curve"), F.xxhash64("id")]
    placed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order) \
        .select("id", "v").mapInArrow(blocks, BLOCK_DDL).write.parquet(path)


def round_sums(blocks: DataFrame, centroids: np.ndarray, inertia: bool = False) -> list[tuple[int, int, list[int]]]:
    """(rows, distance summed if ``inertia``, component sums) of each cluster after an assignment to ``centroids``."""
    k, dims = centroids.shape
    schema = pa.schema([("cluster", pa.int32()), ("what", pa.int32()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for b in batch.to_pylist():
                picks = candidates(np.frombuffer(b["lo"], "<i4"), np.frombuffer(b["hi"], "<i4"), centroids)
                if len(picks) == 1 and not inertia:  # settled by the zone map
                    groups = [(int(picks[0]), b["n"], [], np.frombuffer(b["sums"], "<i8"))]
                else:
                    x, cluster, d = assign_block(b, centroids, picks)
                    groups = [(int(c), int((cluster == c).sum()), d[cluster == c].tolist(),
                               x[cluster == c].sum(0)) for c in np.unique(cluster)]
                for c, n, dist, sums in groups:
                    for what, value in enumerate([n, sum(dist), *sums.tolist()]):
                        total[c, what] = total.get((c, what), 0) + value
        # Python's whole numbers have no bound: high and low parts of 32 bits leave for Spark's sums
        rows = [(c, 2 * w + part, v >> 32 if part else v & 0xFFFFFFFF) for (c, w), v in total.items() for part in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows) if rows else [[]] * 3, schema)],
                                         schema=schema)

    sums = blocks.mapInArrow(run, "cluster int, what int, value long").groupBy("cluster", "what").agg(
        F.sum(F.col("value").cast("decimal(28,0)")).alias("value")).collect()  # k * 2 (dims + 2) rows
    got: dict[tuple[int, int], int] = {}
    for r in sums:
        at = (r["cluster"], r["what"] // 2)
        got[at] = got.get(at, 0) + (int(r["value"]) << (32 if r["what"] % 2 else 0))
    return [(got.get((c, 0), 0), got.get((c, 1), 0), [got.get((c, 2 + j), 0) for j in range(dims)]) for c in range(k)]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, id_col: str = "vec_id",
            vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Every kept vector with its cluster after ``rounds`` rounds of Lloyd's algorithm in whole numbers.

    Columns: id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256. A round that moves no centroid ends the rounds early, as
    all later ones would repeat it.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kept = _kept(vectors, id_col, vector_col, dims)
    path = f"{checkpoint_dir(spark)}/centroid-blocks-{uuid.uuid4().hex}"
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    write_blocks(kept, path, dims, block)
    blocks = spark.read.schema(BLOCK_DDL).parquet(path)
    for _ in range(rounds):
        sums = round_sums(blocks, centroids)
        moved = np.array([[s // n for s in total] if n else c.tolist() for (n, _, total), c in zip(sums, centroids)])
        same = (moved == centroids).all()
        centroids = moved
        if same:
            break
    sums = round_sums(blocks, centroids, inertia=True)
    return _assigned(spark, blocks, centroids, [s[1] for s in sums], id_col)


def _assigned(spark: SparkSession, blocks: DataFrame, centroids: np.ndarray, inertia: list[int], id_col: str) -> DataFrame:
    """The last assignment, with what is known of each cluster."""
    schema = pa.schema([("id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                picks = candidates(np.frombuffer(b["lo"], "<i4"), np.frombuffer(b["hi"], "<i4"), centroids)
                _, cluster, d = assign_block(b, centroids, picks)
                ids = pa.array(np.frombuffer(b["ids"], "<i8"), mask=~np.frombuffer(b["valid"], np.uint8).astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(d)], schema=schema)

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def as_long(n: int):
        return F.lit(Decimal(n)).cast("decimal(38,0)").try_cast("long")  # null beyond 64 bits

    def of_cluster(values: list):
        return F.element_at(F.array(*values), F.col("cluster") + 1)
    return blocks.mapInArrow(run, "id long, cluster int, distance long").select(
        F.col("id").alias(id_col), "cluster", "distance", of_cluster([as_long(n) for n in inertia]).alias("cluster_inertia"),
        as_long(sum(inertia)).alias("inertia"), of_cluster([F.lit(d) for d in digests]).alias("centroid_sha256"))


def oracle(k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64) -> str:
    """The same result as SQL over ``embeddings``: every vector against every centroid, one step per round."""
    steps = [f"""kept as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = {dims}
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}),
c0 as materialized (
  select row_number() over (order by sha256('{seed}:' || coalesce(cast(vec_id as varchar), '')), v) - 1 as num, v
  from kept qualify num < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select rid, min({{'d': list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'num': c.num}}) as best
  from kept cross join c{r} c group by rid)""")
        if r < rounds:
            steps.append(f"""s{r} as materialized (
  select best.num as num, j, sum(v[j]) as s, count(*) as n
  from a{r} join kept using (rid) cross join (select unnest(range(1, {dims + 1})) as j) group by best.num, j),
m{r} as materialized (
  select num, list(cast((s - ((s % n + n) % n)) // n as bigint) order by j) as v from s{r} group by num),
c{r + 1} as materialized (select c.num, coalesce(m.v, c.v) as v from c{r} c left join m{r} m using (num))""")
    last = f"a{rounds}"
    return "with " + ",\n".join(steps) + f"""
select vec_id, cast(best.num as integer) as cluster, cast(best.d as bigint) as distance,
  cast(sum(best.d) over (partition by best.num) as bigint) as cluster_inertia, cast(sum(best.d) over () as bigint) as inertia,
  sha256(array_to_string(c.v, ',')) as centroid_sha256
from kept join {last} using (rid) join c{rounds} c on c.num = best.num"""


ORACLE = oracle()
