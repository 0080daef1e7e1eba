"""Session helpers: configuration defaults and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "hazelake",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, the cluster's own settings win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only when none is configured."""
    d = spark.conf.get(CHECKPOINT_KEY, None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001  (sessions without a SparkContext handle)
            d = None
    if not d:
        # only local runs may go without a shared folder: on a cluster each node would write to its own disk
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share (master is {master})")
        d = tempfile.mkdtemp(prefix="hazelake-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, d)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never a machine-local temp on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/hazelake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "utc", "local_path", "os"]


def materialize(df, name: str = "stage"):
    """Cut lineage where a result feeds several branches: write it once as Parquet under the
    shared checkpoint folder and read it back. Unlike an RDD checkpoint this computes the plan
    once, survives executor loss, and later reads get column pruning and filter pushdown.
    Never a local checkpoint or a machine-local folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._hz_materialized = True
    return out


TASK_ROWS = 100_000


def spread(df, rows: int = TASK_ROWS):
    """For narrow tables with costly work behind them: rows dealt evenly to the session's cores, and at most about
    `rows` to a task. A scan alone has no more tasks with rows than the files have row groups."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(n)


_COSTLY = ("Aggregate", "Join", "Window", "Repartition", "Rebalance", "Sort", "Deduplicate", "Distinct",
           "Expand", "Generate", "MapInPandas", "FlatMapGroups", "Sample", "LocalLimit", "CollectMetrics")


def _costly(df) -> bool:
    """True when recomputing `df` needs more than scans, filters and projections."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        node = line.lstrip(" :+-!").split(" ")[0]
        if any(node.startswith(c) for c in _COSTLY):
            return True
    return False


def reusable(df, name: str = "stage"):
    """For operators that read their input twice: materialise it unless re-reading is already
    cheap (a materialised table, or only scans/filters/projections over stored files)."""
    if getattr(df, "_hz_materialized", False) or not _costly(df):
        return df
    return materialize(df, name)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `hazelake` importable in executor Python workers (needed where a Python function
    runs inside tasks, e.g. the stateful alert step): zip the package once per SparkContext
    and distribute it with `addPyFile`."""
    import zipfile
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a SparkContext handle ship code differently)
        return
    if id(sc) in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="hazelake-pkg-"), "hazelake.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(id(sc))


MB = 1024 * 1024


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings sized from the input: shuffle partitions so each holds ~256 MB before AQE
    coalescing, the same split size for file scans, skew thresholds at a few partition sizes,
    and a broadcast limit that only dimension-sized tables meet. At 100 TB this gives
    ~400k initial shuffle partitions, which AQE coalesces to the real post-filter volume."""
    parts = max(8, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Set the sized values for keys the cluster left at their defaults; returns what was set."""
    applied = {}
    for k, v in scale_conf(input_bytes).items():
        explicit = spark.sparkContext.getConf().contains(k) if hasattr(spark, "sparkContext") else False
        if not explicit:
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def input_size(spark: SparkSession, path: str) -> int:
    """Bytes under a path, from the file system listing (no data is read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
