"""Weighted k-means++ seeding, Lloyd refinement, coresets and the
three-round k-median, as DataFrame jobs.

Points are ``id BIGINT, p ARRAY<DOUBLE>`` with an optional weight column;
centres are ``cid INT, c ARRAY<DOUBLE>`` (plus ``bucket INT`` when every
bucket of points has its own centres).

Plan shape, per round, for any number of buckets:

* The point set is prepared once (id, vector, weight, bucket) and persisted.
  A bucket is a keyed hash of the id.
* Centres travel in rows of at most ``BLOCK_ROWS`` centres of one bucket. A
  block of all buckets whose size bound fits the user's broadcast threshold is
  broadcast, and the points are never shuffled. Otherwise the points are
  hash-partitioned once by (bucket, salt), and the centre rows are repeated for
  every salt and joined on both: only the centre side moves, and no bucket is
  held by one task. A model of more blocks is met block by block, each point
  carrying its best ``(d2, cid)`` so far.
* Every per-bucket step is a partial + final hash aggregate (a few rows per
  task cross the network); no (point, centre) pairs are emitted.
* Centres live in small parquet tables under ``spark.checkpoint.dir``
  (``ScratchTables``): computed once per round, lineage cut, nothing collected
  to the driver, deleted when the stage is done.
* The seeding distance ``d`` (to the nearest centre chosen so far) is written
  with the points every ``REFRESH`` rounds only; in between it is the minimum
  of that and the distances to the few newest centres, computed in the scan.

Randomness: D1 sampling draws point ``i`` with probability ``w_i d_i / sum``
by an exponential race: the winner is the smallest ``-ln(u_i) / (w_i d_i)``
(Efraimidis and Spirakis, 2006), with ``u_i`` the keyed uniform of
``(seed, stage:round, id)``. One aggregate per round, no ordered prefix sum.
Exact ties on the race key go to the lowest id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.random import keyed_uniform
from quern.functions.vectors import nearest_centre
from quern.session import ScratchTables, broadcast_threshold

STORAGE = StorageLevel.MEMORY_AND_DISK_DESER  # the DataFrame.cache() default: spills to disk, no (de)serialization in memory
REFRESH = 8  # seeding rounds between written frames of points and distances
BLOCK_ROWS = 1024  # centres of one bucket in one row
BLOCKS_IN_PLAN = 8  # blocks that one plan holds; then the best so far is written
CHUNK = 8  # components that one row of the update sums
CELLS = 4  # cells (bucket, salt) for each shuffle partition, so that few stay empty
ROW_OVERHEAD = 96  # bytes per centre row besides its doubles, for size bounds


def _check(k: int, iters: int = 0, n_buckets: int = 1) -> None:
    if k < 1:
        raise ValueError("k must be >= 1")
    if iters < 0:
        raise ValueError("iters must be >= 0")
    if n_buckets < 1:
        raise ValueError("n_buckets must be >= 1")


def bucket_of(id_sql: str, n_buckets: int, seed: int) -> Column:
    """Bucket in ``[0, n_buckets)`` from a keyed hash of the id (balanced for
    any id pattern, stable under retries and re-partitioning)."""
    if n_buckets == 1:
        return F.lit(0).cast("int")
    return F.floor(keyed_uniform(seed, "bucket", id_sql) * F.lit(float(n_buckets))).cast("int")


def _weight(points: DataFrame, weight_col: str | None) -> Column:
    """The weight: BIGINT if the column holds whole numbers, else DOUBLE. A
    NULL, negative, NaN or infinite weight fails the task."""
    if not weight_col:
        return F.lit(1).cast("long")
    whole = isinstance(points.schema[weight_col].dataType, T.IntegralType)
    w = F.col(f"`{weight_col}`").cast("long" if whole else "double")
    good = (w >= 0) if whole else (w >= 0) & (w < float("inf"))
    return F.when(good, w).otherwise(F.raise_error(F.lit("a weight must be a number >= 0")))


def prepare_points(
    points: DataFrame, n_buckets: int = 1, seed: int = 0, weight_col: str | None = None
) -> DataFrame:
    """``bucket, id, p, w``: only the columns the clustering reads. Rows of
    weight 0 stay: the first centre is drawn without regard to weights."""
    return points.select(
        bucket_of("id", n_buckets, seed).alias("bucket"),
        F.col("id").cast("long").alias("id"),
        F.col("p"),
        _weight(points, weight_col).alias("w"),
    )


# ------------------------------------------------------- points meet centres


@dataclass(frozen=True)
class Layout:
    """How the centre side of a join reaches the points."""

    blocks: int  # centre rows per bucket
    salts: int  # 0: broadcast; else the points are laid out by (bucket, salt)
    parts: int


def _layout(points: DataFrame, n_buckets: int, k: int, dim: int) -> Layout:
    """Broadcast if one block of every bucket fits the broadcast threshold
    (bound: centres x (8 x dim + overhead) bytes), else by (bucket, salt)."""
    k = max(k, 1)
    blocks = -(-k // BLOCK_ROWS)
    if n_buckets * min(k, BLOCK_ROWS) * (8 * dim + ROW_OVERHEAD) <= broadcast_threshold(points.sparkSession):
        return Layout(blocks, 0, 0)
    parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return Layout(blocks, max(1, -(-CELLS * parts // n_buckets)), parts)


def _laid_out(points: DataFrame, layout: Layout, by: str = "id") -> DataFrame:
    if not layout.salts:
        return points
    salted = points.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(layout.salts)).cast("int"))
    return salted.repartition(layout.parts, "bucket", "salt")


def _meet(points: DataFrame, small: DataFrame, layout: Layout, how: str = "inner") -> DataFrame:
    """Joins centre-side rows (keyed by bucket) to the points of the bucket."""
    if not layout.salts:
        return points.join(F.broadcast(small), "bucket", how)
    cells = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(layout.salts - 1))))
    return points.join(cells, ["bucket", "salt"], how)


def vector_dim(points: DataFrame) -> int:
    """Dimension of the first point (one row read); 0 for an empty set."""
    row = points.select(F.size("p").alias("n")).first()
    return int(row["n"]) if row else 0


def _lists(centres: DataFrame, layout: Layout) -> DataFrame:
    """``bucket, block, cs``: each bucket's centres as arrays of ``(cid, c)``,
    cut by position in the order of ``cid`` into blocks of ``BLOCK_ROWS``. Only
    the centre table is sorted."""
    block = F.lit(0)
    if layout.blocks > 1:
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy("cid"))
        block = F.floor((nth - 1) / F.lit(BLOCK_ROWS))
    rows = centres.select("bucket", block.cast("int").alias("block"), F.struct(F.col("cid").cast("int").alias("cid"), "c").alias("e"))
    return rows.groupBy("bucket", "block").agg(F.collect_list("e").alias("cs"))


def _unlist(lists: DataFrame) -> DataFrame:
    """``bucket, cid, c`` from the list form."""
    return lists.select("bucket", F.explode("cs").alias("e")).select(
        "bucket", F.col("e.cid").alias("cid"), F.col("e.c").alias("c")
    )


def _assign(pts: DataFrame, lists: DataFrame, layout: Layout, tables: ScratchTables) -> DataFrame:
    """Adds ``cid`` (nearest centre of the point's bucket) and ``d2``; both
    NULL in a bucket without centres."""
    columns, cur, written = pts.columns, pts, None
    for b in range(layout.blocks):
        part = lists if layout.blocks == 1 else lists.where(F.col("block") == b)
        near = nearest_centre("p", "cs")
        best = near if b == 0 else F.least("best", near)
        cur = _meet(cur, part.select("bucket", "cs"), layout, "left").select(*columns, best.alias("best"))
        if (b + 1) % BLOCKS_IN_PLAN == 0 and b + 1 < layout.blocks:
            before, written = written, tables.put(cur, "best")
            cur = written.repartition(layout.parts, "bucket", "salt") if layout.salts else written
            if before is not None:
                tables.drop(before)
    return cur.select(*columns, F.col("best.cid").alias("cid"), F.col("best.d2").alias("d2"))


# ----------------------------------------------------------------- seeding


def _pick(cand: DataFrame, cid: int, grouped: bool) -> DataFrame:
    """Per bucket, the row with the smallest ``key`` (lowest id on ties, NULL
    keys never): ``bucket, cid, id, c``. One aggregate, so the distances behind
    the keys are computed once a round; with many buckets each task sorts its
    rows by bucket, which costs less than a second pass over the distances."""
    rows, row = cand.where("key IS NOT NULL"), F.struct("key", "id", "p")
    if grouped:
        best = rows.groupBy("bucket").agg(F.min(row).alias("m"))
    else:
        best = rows.select(F.min(row).alias("m")).where("m IS NOT NULL").withColumn("bucket", F.lit(0).cast("int"))
    return best.select("bucket", F.lit(cid).cast("int").alias("cid"), F.col("m.id").alias("id"), F.col("m.p").alias("c"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _seed(pts: DataFrame, k: int, seed: int, stage: str, n_buckets: int, layout: Layout, tables: ScratchTables) -> DataFrame:
    """Picks of every round, ``bucket, cid, id, c``, from persisted points."""
    columns, grouped = pts.columns, n_buckets > 1

    def u(r: int) -> Column:
        return keyed_uniform(seed, f"{stage}:{r}", "id")

    def measured(frame: DataFrame, newest: list[DataFrame]) -> DataFrame:
        """``frame`` with ``d`` brought up to date with the newest picks."""
        if not newest:
            return frame
        one = Layout(1, layout.salts, layout.parts)
        met = _meet(frame, _lists(_union(newest), one).select("bucket", "cs"), one, "left")
        d = F.sqrt(nearest_centre("p", "cs")["d2"])  # NULL where a bucket has no newer pick
        return met.select(*columns, (F.least("d", d) if "d" in frame.columns else d).alias("d"))

    # Round 0: uniform over the points, weights ignored.
    picks = [tables.put(_pick(pts.withColumn("key", -F.ln(u(0))), 0, grouped), f"{stage}-pick0")]
    frame, newest, written = pts, [picks[0]], None
    for r in range(1, k):
        # d > 0 leaves out the chosen centres and exact copies of them.
        key = F.when((F.col("d") > 0) & (F.col("w") > 0), -F.ln(u(r)) / (F.col("w") * F.col("d")))
        picks.append(tables.put(_pick(measured(frame, newest).withColumn("key", key), r, grouped), f"{stage}-pick{r}"))
        newest.append(picks[-1])
        if len(newest) == REFRESH and r + 1 < k:
            before, frame_before = written, frame
            written = tables.put(measured(frame, newest), f"{stage}-frame")
            frame = written.repartition(layout.parts, "bucket", "salt") if layout.salts else written
            frame, newest = frame.persist(STORAGE), []
            if before is not None:
                frame_before.unpersist(blocking=False)
                tables.drop(before)
    if written is not None:
        frame.unpersist(blocking=False)
        tables.drop(written)
    return _union(picks)


# ------------------------------------------------------------------- Lloyd


def _update(pts: DataFrame, lists: DataFrame, layout: Layout, tables: ScratchTables, dim: int) -> DataFrame:
    """One Lloyd step inside every bucket: ``bucket, cid, c``.

    Each centre moves to the weighted mean of its points; a centre without
    points keeps its place. Vectors are summed in the partial aggregate, one
    sum for each of ``CHUNK`` components: a point of up to that many components
    is one row of it, a longer one a row for each chunk; a large cluster costs
    one row per task and chunk. The old centres then join the few sums as rows
    of weight 0, so the work is linear in the number of centres. (A join on
    the nearest centre would make Catalyst evaluate it again in a filter.)
    """
    a = _assign(pts, lists, layout, tables)
    chunks = max(1, -(-dim // CHUNK))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))) if chunks > 1 else F.lit(0)
    rows = a.select("bucket", "cid", "p", "w", chunk.alias("chunk"))
    width = max(1, min(dim, CHUNK))
    sums = [F.sum(F.expr(f"w * get(p, chunk * {CHUNK} + {j})")).alias(f"s{j}") for j in range(width)]
    moved = rows.groupBy("bucket", "cid", "chunk").agg(F.sum("w").alias("w"), *sums)
    means = F.array(*[F.when(F.col("w") > 0, F.col(f"s{j}") / F.col("w")) for j in range(width)])
    part = F.slice(means, F.lit(1), F.least(F.lit(width), F.lit(dim) - F.col("chunk") * CHUNK))
    new = F.struct("chunk", part.alias("v")).alias("new")
    both = moved.where("w > 0").select("bucket", "cid", new, F.lit(None).cast("array<double>").alias("old"))
    both = both.unionByName(_unlist(lists).select("bucket", "cid", F.lit(None).cast(both.schema["new"].dataType).alias("new"), F.col("c").alias("old")))
    met = both.groupBy("bucket", "cid").agg(F.sort_array(F.collect_list("new")).alias("new"), F.max("old").alias("old"))
    c = F.expr("if(size(new) = 0, old, flatten(transform(new, _x -> _x.v)))")
    return met.where("old IS NOT NULL").select("bucket", "cid", c.alias("c"))


def _lloyd(
    pts: DataFrame, lists: DataFrame, iters: int, layout: Layout, tables: ScratchTables, stage: str, dim: int
) -> DataFrame:
    """List form after ``iters`` steps (written, if there is a step)."""
    before = None
    for it in range(iters):
        lists = tables.put(_lists(_update(pts, lists, layout, tables, dim), layout), f"{stage}-lloyd{it}")
        if before is not None:
            tables.drop(before)
        before = lists
    return lists


def _kmeanspp(
    pts: DataFrame, k: int, iters: int, seed: int, stage: str, n_buckets: int, layout: Layout, tables: ScratchTables, dim: int
) -> DataFrame:
    """Seeding then Lloyd in every bucket; returns the list form."""
    lists = _lists(_seed(pts, k, seed, stage, n_buckets, layout, tables), layout)
    if k > REFRESH:  # the picks of fewer rounds are read as they are
        lists = tables.put(lists, f"{stage}-seeds")
    return _lloyd(pts, lists, iters, layout, tables, stage, dim)


def _finished(lists: DataFrame, iters: int, tables: ScratchTables) -> DataFrame:
    """``cid, c`` of a one-bucket model: the last step's table, if there was a
    step, is all that stays."""
    out = _unlist(lists).select("cid", "c")
    if not iters:
        return tables.finish(out)
    tables.keep(lists)
    return out


def _with_weights(centres: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """Centres with the summed weight of their points, 0 if none. The centres
    enter the aggregate as weight-0 rows: with a join on ``cid``, Catalyst
    would evaluate the nearest centre of each point a second time to filter."""
    kind = weights.schema["w"].dataType
    both = weights.select(*keys, "w", F.lit(None).cast("array<double>").alias("c")).unionByName(
        centres.select(*keys, F.lit(0).cast(kind).alias("w"), "c")
    )
    return both.groupBy(*keys).agg(F.sum("w").alias("w"), F.max("c").alias("c")).select(*keys, "c", "w")


# ---------------------------------------------------------------- public API


def seed_centres(points: DataFrame, k: int, seed: int = 0, n_buckets: int = 1,
                 weight_col: str | None = None, stage: str = "seed") -> DataFrame:
    """k-means++ seeding with D1 weights: ``bucket, cid, id, c``.

    ``cid`` is the draw order. A bucket with fewer than ``k`` distinct
    points gets fewer centres (the draw stops when every remaining point
    sits on a centre).
    """
    _check(k, 0, n_buckets)
    tables = ScratchTables(points.sparkSession, stage)
    pts = prepare_points(points, n_buckets, seed, weight_col)
    layout = _layout(pts, n_buckets, min(k, REFRESH), vector_dim(pts))  # the newest picks are all that travels
    pts = _laid_out(pts, layout).persist(STORAGE)
    try:
        return tables.finish(_seed(pts, k, seed, stage, n_buckets, layout, tables))
    finally:
        pts.unpersist(blocking=False)


def first_centres(points: DataFrame, k: int) -> DataFrame:
    """``cid, id, c``: the ``k`` points with the smallest ids (a top-k, one
    small task), numbered 0.. in id order."""
    _check(k)
    top = points.select("id", "p").orderBy("id").limit(k)
    arr = top.agg(F.sort_array(F.collect_list(F.struct("id", "p"))).alias("a"))
    return arr.select(F.posexplode("a").alias("cid", "e")).select(
        F.col("cid").cast("int").alias("cid"), F.col("e.id").alias("id"), F.col("e.p").alias("c")
    )


def model_stats(centres: DataFrame) -> tuple[int, int]:
    """``(rows, dim)`` of a centre model: one small aggregate over the centre
    table, the proof behind its broadcast."""
    r = centres.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("c")).alias("dim")).first()
    return int(r["n"]), int(r["dim"] or 0)


def _one_bucket(centres: DataFrame) -> DataFrame:
    return centres.select(F.lit(0).cast("int").alias("bucket"), "cid", "c")


def assign_nearest(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Adds ``cid`` and ``d`` (Euclidean distance) of each point's nearest
    centre; ties go to the lowest ``cid``; NULL without centres.

    The model (``cid, c``, any ids) travels in rows of ``BLOCK_ROWS`` centres,
    so the step is a narrow projection over the points without k-fold join
    output. Its size is counted first (``model_stats``): see ``_layout``.
    """
    layout = _layout(points, 1, *model_stats(centres))
    tables = ScratchTables(points.sparkSession, "assign")
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("row")
    pts = _laid_out(points.select(F.lit(0).cast("int").alias("bucket"), row, "p"), layout, "p")
    done = _assign(pts, _lists(_one_bucket(centres), layout), layout, tables)
    return done.select("row.*", "cid", F.sqrt("d2").alias("d"))


def objective(points: DataFrame, centres: DataFrame) -> DataFrame:
    """``objective``: mean distance from a point to its nearest centre."""
    return assign_nearest(points, centres).agg(F.avg("d").alias("objective"))


def cluster_weights(points: DataFrame, centres: DataFrame, weight_col: str | None = None) -> DataFrame:
    """``cid, w``: total weight (unit weights: number) of points per centre
    that has any; BIGINT for whole-number weights, else DOUBLE."""
    weighed = points.select("p", _weight(points, weight_col).alias("w"))
    return assign_nearest(weighed, centres).groupBy("cid").agg(F.sum("w").alias("w"))


def cluster_sizes(points: DataFrame, centres: DataFrame, weight_col: str | None = None) -> DataFrame:
    """``cid, c, w``: every centre with the total weight of its points."""
    weights = cluster_weights(points, centres, weight_col)
    return _with_weights(centres.select("cid", "c"), weights, ["cid"]).where("c IS NOT NULL")


def _on_model(points: DataFrame, centres: DataFrame, weight_col: str | None) -> tuple[DataFrame, DataFrame, Layout, int]:
    """Prepared points, the model's list form, their layout, and the dimension."""
    pts = prepare_points(points, 1, 0, weight_col)
    k, dim = model_stats(centres)
    layout = _layout(pts, 1, k, dim)
    return _laid_out(pts, layout), _lists(_one_bucket(centres), layout), layout, dim


def centroid_update(points: DataFrame, centres: DataFrame, weight_col: str | None = None) -> DataFrame:
    """``cid, c``: one Lloyd step against fixed centres (weighted means)."""
    pts, lists, layout, dim = _on_model(points, centres, weight_col)
    return _update(pts, lists, layout, ScratchTables(points.sparkSession, "update"), dim).select("cid", "c")


def lloyd(points: DataFrame, centres: DataFrame, iters: int, weight_col: str | None = None) -> DataFrame:
    """``cid, c`` after ``iters`` Lloyd rounds from the given centres."""
    _check(1, iters)
    tables = ScratchTables(points.sparkSession, "lloyd")
    pts, lists, layout, dim = _on_model(points, centres, weight_col)
    pts = pts.persist(STORAGE)
    try:
        return _finished(_lloyd(pts, lists, iters, layout, tables, "lloyd", dim), iters, tables)
    finally:
        pts.unpersist(blocking=False)


def coreset(points: DataFrame, k: int, n_buckets: int, iters: int, seed: int = 0) -> DataFrame:
    """Round 1 of the k-median: ``bucket, cid, c, w``.

    Points are spread over ``n_buckets`` buckets by a keyed hash; in every
    bucket, k-means++ seeding (unit weights) and ``iters`` Lloyd rounds give
    up to ``k`` centres, each weighted by the number of the bucket's points
    nearest to it. Centres that attract no point are left out.
    """
    return _coreset(points, k, n_buckets, iters, seed, ScratchTables(points.sparkSession, "coreset"))[0]


def _coreset(points: DataFrame, k: int, n_buckets: int, iters: int, seed: int, tables: ScratchTables) -> tuple[DataFrame, int]:
    _check(k, iters, n_buckets)
    pts = prepare_points(points, n_buckets, seed)
    dim = vector_dim(pts)
    layout = _layout(pts, n_buckets, k, dim)
    pts = _laid_out(pts, layout).persist(STORAGE)
    try:
        lists = _kmeanspp(pts, k, iters, seed, "coreset", n_buckets, layout, tables, dim)
        weights = _assign(pts, lists, layout, tables).groupBy("bucket", "cid").agg(F.sum("w").alias("w"))
        out = _with_weights(_unlist(lists), weights, ["bucket", "cid"]).where("w > 0")
        return tables.finish(out, "coreset"), dim
    finally:
        pts.unpersist(blocking=False)


def _one_model(pts: DataFrame, k: int, iters: int, seed: int, stage: str, dim: int) -> DataFrame:
    """``cid, c`` of k-means++ and Lloyd over prepared points in one bucket."""
    tables = ScratchTables(pts.sparkSession, stage)
    layout = _layout(pts, 1, k, dim)
    pts = _laid_out(pts, layout).persist(STORAGE)
    try:
        return _finished(_kmeanspp(pts, k, iters, seed, stage, 1, layout, tables, dim), iters, tables)
    finally:
        pts.unpersist(blocking=False)


def recluster(core: DataFrame, k: int, iters: int, seed: int = 0, dim: int | None = None) -> DataFrame:
    """Round 2: weighted k-means++ and Lloyd on the coreset rows: ``cid, c``.

    Each coreset row is a point with id ``bucket * k + cid`` and its weight.
    ``dim``: the vector dimension when the caller knows it (saves one job).
    """
    _check(k, iters)
    rows = core.select(
        (F.col("bucket").cast("long") * F.lit(k) + F.col("cid")).alias("id"),
        F.col("c").alias("p"),
        F.col("w"),
    )
    pts = prepare_points(rows, 1, seed, "w")
    return _one_model(pts, k, iters, seed, "recluster", dim or vector_dim(pts))


def kmedian(points: DataFrame, k: int, n_buckets: int, iters: int, seed: int = 0) -> DataFrame:
    """Three-round k-median: coreset per bucket, reclustering of the coreset;
    returns the final centres ``cid, c``. Round 3 is ``objective``."""
    tables = ScratchTables(points.sparkSession, "coreset")
    core, dim = _coreset(points, k, n_buckets, iters, seed, tables)
    out = recluster(core, k, iters, seed, dim)
    tables.clear()
    return out


def kmedian_direct(points: DataFrame, k: int, iters: int, seed: int = 0) -> DataFrame:
    """k-means++ and Lloyd on all points (unit weights), no coreset."""
    _check(k, iters)
    pts = prepare_points(points, 1, seed)
    return _one_model(pts, k, iters, seed, "direct", vector_dim(pts))
