"""Session helpers: a local session for tests and the bench, the shared
folder for lineage cuts and scratch tables, and the broadcast threshold."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quern") -> SparkSession:
    """A local session: AQE on, UI off, UTC, Arrow on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local session without one gets a fresh
    private folder (tests); on a cluster a missing setting is an error,
    because a machine-local folder would not survive an executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the session conf is visible
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return root.rstrip("/")
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="quern-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


class ScratchTables:
    """Intermediate tables written as parquet under the checkpoint folder: each
    is computed once, survives executor loss, and starts a fresh lineage for
    the next step. ``drop`` and ``finish`` delete what is no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/quern-{label}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        self.paths: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{self.count:03d}-{name}"
        self.count += 1
        df.write.mode("errorifexists").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete the files of these tables (others are left alone)."""
        for df, path in [x for x in self.paths if any(x[0] is t for t in tables)]:
            self._delete(path)
            self.paths = [x for x in self.paths if x[0] is not df]

    def keep(self, *tables: DataFrame) -> None:
        """Delete all tables but these."""
        self.drop(*[df for df, _ in self.paths if not any(df is t for t in tables)])

    def finish(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Write ``df`` and delete every other table: only the result's own
        files remain."""
        out = self.put(df, name)
        self.keep(out)
        return out

    def clear(self) -> None:
        """Delete every table."""
        self._delete(self.root)
        self.paths = []

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


_UNITS = {
    unit: 1 << shift
    for shift, units in ((0, " b"), (10, "k kb"), (20, "m mb"), (30, "g gb"), (40, "t tb"), (50, "p pb"))
    for unit in units.split(" ")
}


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 = never)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([a-z]*)", raw)
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"spark.sql.autoBroadcastJoinThreshold: cannot read {raw!r}")
    n = int(m.group(1))
    return n if n < 0 else n * _UNITS[m.group(2)]
