"""Exact k-means steps over integer vectors in Hilbert-ordered blocks with zone
maps.

Vectors are ordered along a Hilbert curve through their coordinates on the
``AXES`` directions of largest variance and cut, in this order, into blocks of
neighbours. A block keeps its vectors, their sum, and its box: the least and
largest coordinate on each of the principal directions (what parts clusters lies in
few of them, so boxes are tighter there than by component). In a round, bounds over the box
on the difference of two squared distances show which centroids cannot be
nearest to any vector of the block (``candidates``). A block
with one candidate adds its sum without a look at its vectors; the others are
compared with their candidates only, all at once in numpy. The curve decides
the layout alone; results are exact whatever it is.

A round is one pass over the written blocks; each task gives one row a
centroid with exact sums, and the new centroids are the only thing that
returns to the driver (their number and length do not grow with the data).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_arrow
from quern.session import ScratchTables

DIM, SCALE, K, ROUNDS = 64, 1024, 8, 10
BLOCK = 256  # vectors
AXES, AXIS_BITS = 6, 10  # 60 bits of a curve's place
LIMIT = 1 << 26  # of an integer component, so that a distance fits 64 bits

_BLOCKS = "n int, ids binary, null_ids binary, q binary, low binary, high binary, total binary"


# ------------------------------------------------------------- numpy kernels


def integers(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have exactly ``dim`` components, none null or not finite, and
    the integers of these rows."""
    sizes = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
    keep = sizes == dim
    got = column.filter(pa.array(keep)).flatten()
    x = got.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dim)
    fine = np.isfinite(x).all(1)
    keep[np.flatnonzero(keep)[~fine]] = False
    x = np.floor(scale * x[fine])
    if (np.abs(x) > LIMIT).any():
        raise ValueError(f"a component is beyond {LIMIT / scale:g}: its distances may not fit 64 bits")
    return keep, x.astype(np.int64)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (components below
    ``2**bits``). From the top bit down, a component whose bit is set flips the
    lower bits of the first one, one whose bit is not set swaps its lower bits
    with them; the components then are, in Gray code, the place's bits in turn."""
    x = cells.astype(np.uint64).T.copy()
    for bit in range(bits - 1, 0, -1):
        lower = np.uint64((1 << bit) - 1)
        for axis in range(len(x)):
            up = (x[axis] >> np.uint64(bit)) & np.uint64(1) == 1
            swap = np.where(up, 0, (x[0] ^ x[axis]) & lower)
            x[0] = np.where(up, x[0] ^ lower, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    fix = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        fix ^= np.where((x[-1] >> np.uint64(bit)) & np.uint64(1) == 1, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= fix
    place = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            place = (place << np.uint64(1)) | ((x[axis] >> np.uint64(bit)) & np.uint64(1))
    return place.astype(np.int64)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector of the box
    (all in coordinates on the same orthonormal directions).

    How much farther the centroid next to the box's middle is than another one
    is, as a difference of squared distances, linear in the vector, so over the
    box it is largest in a corner, found for each direction by itself. If even
    there it is below 0 by more than rounding can do, the other centroid is no
    candidate; one that can tie stays."""
    middle = centroids[((2 * centroids - (low + high)) ** 2).sum(1).argmin()]
    more = lambda x: (x - middle) ** 2 - (x - centroids) ** 2
    slack = 1e-9 * (1 + (np.maximum(np.abs(low), np.abs(high)) ** 2).sum() + (centroids**2).sum(1).max())
    return np.flatnonzero(np.maximum(more(low), more(high)).sum(1) >= -slack)


def nearest(q: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (the lowest number in a tie) and the
    squared distance, exact in 64-bit integers."""
    d = np.stack([((q - centroids[c]) ** 2).sum(1) for c in among.tolist()], 1)
    first = d.argmin(1)  # candidates ascend
    return among[first], d[np.arange(len(q)), first]


# --------------------------------------------------------------------- tasks


def _moments(dim: int, scale: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and products of the kept vectors of a task, one row each."""
    n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
    for batch in batches:
        _, q = integers(batch.column("v"), dim, scale)
        x = q.astype(np.float64)
        n, first, second = n + len(x), first + x.sum(0), second + x.T @ x
    values = np.concatenate([[n], first, second.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["at", "value"])


def _extent(axes: np.ndarray, dim: int, scale: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, high = np.full(len(axes), np.inf), np.full(len(axes), -np.inf)
    for batch in batches:
        _, q = integers(batch.column("v"), dim, scale)
        if len(q):
            y = q @ axes.T
            low, high = np.minimum(low, y.min(0)), np.maximum(high, y.max(0))
    at = pa.array(np.arange(len(axes), dtype=np.int32))
    yield pa.RecordBatch.from_arrays([at, pa.array(low), pa.array(high)], names=["at", "low", "high"])


def _placed(axes, low, width, dim: int, scale: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, q = integers(batch.column("v"), dim, scale)
        cells = np.clip((q @ axes.T - low) / width * (1 << AXIS_BITS), 0, (1 << AXIS_BITS) - 1).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hilbert(cells, AXIS_BITS)), batch.column("vec_id").filter(pa.array(keep)), _rows(q.astype("<i4"))],
            names=["place", "vec_id", "q"],
        )


def _rows(a: np.ndarray) -> pa.Array:
    """Each row of the array as one binary value."""
    a = np.ascontiguousarray(a)
    return pa.array([x.tobytes() for x in a], pa.binary())


def _cut(axes: np.ndarray, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted vectors of a task."""
    ids, q = [], []
    for batch in batches:
        ids += batch.column("vec_id").to_pylist()
        q += batch.column("q").to_pylist()
        if len(ids) >= 16 * block:
            whole = len(ids) // block * block
            yield _made(ids[:whole], q[:whole], axes, block)
            ids, q = ids[whole:], q[whole:]
    if ids:
        yield _made(ids, q, axes, block)


def _made(ids: list, rows: list[bytes], axes: np.ndarray, block: int) -> pa.RecordBatch:
    q = np.frombuffer(b"".join(rows), "<i4").reshape(-1, len(axes))
    y = (q @ axes.T).astype("<f8")
    cuts = [slice(i, i + block) for i in range(0, len(ids), block)]
    null = np.array([x is None for x in ids], bool)
    number = np.array([x or 0 for x in ids], "<i8")
    columns = [[x.tobytes() for x in xs] for xs in (
        [number[c] for c in cuts], [null[c] for c in cuts], [q[c] for c in cuts],
        [y[c].min(0) for c in cuts], [y[c].max(0) for c in cuts], [q[c].sum(0, dtype=np.int64) for c in cuts],
    )]
    names = [x.split()[0] for x in _BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(q[c]) for c in cuts], pa.int32()), *[pa.array(x, pa.binary()) for x in columns]], names=names
    )


def _among(row: dict, turned: np.ndarray) -> np.ndarray:
    return candidates(np.frombuffer(row["low"], "<f8"), np.frombuffer(row["high"], "<f8"), turned)


def _vectors(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(-1, dim).astype(np.int64)


def _step(centroids: np.ndarray, axes: np.ndarray, inertia: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a centroid: number of its vectors, their sum, and the sum of
    their distances if asked for."""
    (k, dim), turned = centroids.shape, centroids @ axes.T
    count, total, far = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), [0] * k
    for batch in batches:
        for row in batch.to_pylist():
            among = _among(row, turned)
            if len(among) == 1 and not inertia:
                count[among[0]] += row["n"]
                total[among[0]] += np.frombuffer(row["total"], "<i8")
                continue
            q = _vectors(row["q"], dim)
            own, d = nearest(q, centroids, among)
            for c in among.tolist():
                mine = own == c
                count[c] += mine.sum()
                total[c] += q[mine].sum(0)
                far[c] += sum(d[mine].tolist())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(k, dtype=np.int32)), pa.array(count),
            pa.ListArray.from_arrays(pa.array(np.arange(k + 1, dtype=np.int32) * dim), pa.array(total.ravel())),
            pa.array([str(x) for x in far], pa.string()),
        ],
        names=["cluster", "n", "total", "far"],
    )


def _assigned(centroids: np.ndarray, axes: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turned = centroids @ axes.T
    for batch in batches:
        for row in batch.to_pylist():
            among = _among(row, turned)
            own, d = nearest(_vectors(row["q"], centroids.shape[1]), centroids, among)
            ids = pa.array(np.frombuffer(row["ids"], "<i8"), mask=np.frombuffer(row["null_ids"], bool))
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])


# --------------------------------------------------------------------- Spark


def blocks(vectors: DataFrame, tables: ScratchTables, dim: int, scale: float, block: int) -> tuple[DataFrame, np.ndarray]:
    """The written blocks of ``vec_id, v``, in Hilbert order within each task,
    and the directions of their boxes, one a row."""
    moments = map_arrow(vectors.select("v"), partial(_moments, dim, scale), "at int, value double").groupBy("at").agg(F.sum("value"))
    got = dict(map(tuple, moments.collect()))  # 1 + dim + dim**2 rows
    flat = np.array([got.get(i, 0.0) for i in range(1 + dim + dim * dim)])
    n, mean = max(flat[0], 1), flat[1 : dim + 1] / max(flat[0], 1)
    spread = flat[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean)
    turn = np.linalg.eigh((spread + spread.T) / 2)[1].T[::-1]
    axes = turn[:AXES]
    extent = map_arrow(vectors.select("v"), partial(_extent, axes, dim, scale), "at int, low double, high double")
    ends = extent.groupBy("at").agg(F.min("low"), F.max("high")).orderBy("at").collect()  # AXES rows
    low = np.array([x[1] for x in ends] if ends else np.zeros(len(axes)))
    width = np.array([x[2] for x in ends] if ends else np.ones(len(axes))) - low
    low, width = (low, np.where(width > 0, width, 1)) if flat[0] else (np.zeros(len(axes)), np.ones(len(axes)))
    placed = map_arrow(vectors, partial(_placed, axes, low, width, dim, scale), "place bigint, vec_id bigint, q binary")
    # The id and the row's place part vectors that are equal.
    key = ["place", "vec_id", "at"]
    dealt = placed.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key)
    return tables.put(map_arrow(dealt.select("vec_id", "q"), partial(_cut, turn, block), _BLOCKS), "blocks"), turn


def first_centroids(vectors: DataFrame, k: int, dim: int, scale: float) -> np.ndarray:
    """The ``k`` kept vectors of the lowest hash of ``3:<vec_id>``, in order."""
    hashed = vectors.withColumn("hash", F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256))
    ints = f"transform(v, x -> CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"
    kept = f"size(v) = {dim} AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    first = hashed.where(kept).select("hash", F.expr(ints).alias("q")).orderBy(F.col("hash").asc_nulls_last(), "q").limit(k)
    return np.array([r.q for r in first.collect()], np.int64).reshape(-1, dim)


def _sums(of: DataFrame, centroids: np.ndarray, axes: np.ndarray, inertia: bool) -> dict[int, tuple[int, list[int], int]]:
    """Count, component sums and inertia of each centroid, exact (decimals)."""
    step = map_arrow(of, partial(_step, centroids, axes, inertia), "cluster int, n bigint, total array<bigint>, far string")
    sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(centroids.shape[1])]
    got = step.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("far").cast("decimal(38,0)")).alias("far"), *sums)
    return {r[0]: (r[1], [int(x) for x in r[3:]], int(r[2])) for r in got.collect()}  # one row a centroid


def clusters(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
    dim: int = DIM, scale: int = SCALE, block: int = BLOCK,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``
    of every kept vector after ``rounds`` rounds and a last assignment.

    Kept are vectors with exactly ``dim`` components, none null or not finite;
    others (a null vector too) have no row. Components become ``floor(scale * x)``; one beyond ``LIMIT`` fails
    the job, as distances may then not fit 64 bits. Rows are vectors of their own even if
    they are equal; equal hashes of ids are ordered by the vector, null ids come last. With fewer than ``k`` kept
    vectors all of them are centroids; without any the result is empty. A
    centroid that attracts no vector stays. Ids must be whole numbers.
    """
    spark = vectors.sparkSession
    tables = ScratchTables(spark, "zones")
    vectors = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    centroids = first_centroids(vectors, k, dim, scale)
    of, axes = blocks(vectors, tables, dim, scale, block)
    if not len(centroids):
        centroids = np.zeros((1, dim), np.int64)
    for _ in range(rounds):
        got = _sums(of, centroids, axes, False)
        moved = [[x // got[c][0] for x in got[c][1]] if c in got and got[c][0] else old for c, old in enumerate(centroids.tolist())]
        centroids = np.array(moved, np.int64)
    last = _sums(of, centroids, axes, True)
    whole = sum(x[2] for x in last.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(c, last[c][2] if c in last else 0, whole, digests[c]) for c in range(len(centroids))]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    found = map_arrow(of, partial(_assigned, centroids, axes), "vec_id bigint, cluster int, distance bigint")
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> str:
    """The same in DuckDB: one pair of tables for each round."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, q) - 1 AS INTEGER) AS cluster, q AS c
  FROM kept QUALIFY cluster < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(vec_id) AS vec_id, min(q) AS q, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT r, vec_id, q, cluster, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM kept CROSS JOIN c{i})
  GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(any_value(m.c), any_value(c{i}.c)) AS c
  FROM c{i} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c
    FROM (SELECT cluster, pos, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM a{i})
          GROUP BY cluster, pos)
    GROUP BY cluster) AS m USING (cluster)
  GROUP BY c{i}.cluster)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


ORACLE = _oracle()
