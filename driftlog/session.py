"""Session helpers: the settings every operator assumes, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on (UTC session clock, AQE, Arrow batches).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "driftlog") -> SparkSession:
    """A local session for tests and the bench (the cluster passes its own session)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.environ.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        os.environ["PYTHONPATH"] = root + (os.pathsep + paths if paths else "")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("DRIFTLOG_DRIVER_MEMORY", "8g"))
        # delete reliable checkpoints once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _SHIPPED.add(id(spark.sparkContext._jsc))  # workers inherit PYTHONPATH locally
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (the driver's or a cluster's)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None when unset)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf
    d = spark.sparkContext._jsc.sc().getCheckpointDir()
    return d.get() if d.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables; set once per context.

    ``setCheckpointDir`` makes a subfolder of what it is given, so it is called only while the
    context has none: calling it with its own last answer would nest folders without end.
    """
    sc = spark.sparkContext
    d = checkpoint_dir(spark)
    if d is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="driftlog-ckpt-", dir="/tmp")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``driftlog`` importable in Python workers (once per SparkContext).

    Operators whose tasks run Python (mapInArrow folds) call this; on a cluster
    it distributes a zip of the package the way ``--py-files`` would.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    if sc.getConf().get("spark.driftlog.shipped", "") == "1":
        _SHIPPED.add(key)
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = tempfile.mkdtemp(prefix="driftlog-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "driftlog"), "zip", root_dir=root, base_dir="driftlog")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


# Inputs estimated above this size fold in range mode (a hot key may outgrow one task);
# below it, one task per key is cheaper. Override with spark.driftlog.rangeFoldMinBytes.
RANGE_FOLD_MIN_BYTES = 1 << 30


def estimated_bytes(df) -> int:
    """Input volume of a plan: the summed size of its leaves (file scans, local rows).

    Join estimates multiply sizes, so the plan's own estimate is useless here;
    the leaves are what the job reads. No job runs.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        known = 0
        for i in range(leaves.size()):
            v = leaves.apply(i).stats().sizeInBytes()
            v = int(v if isinstance(v, int) else v.toString())
            if v >= (1 << 63) - 1:  # no statistics (e.g. an RDD-backed leaf): assume large
                return 1 << 62
            known += v
        return known
    except Exception:  # noqa: BLE001 - statistics unavailable: assume large
        return 1 << 62


def fold_mode(df, mode: str) -> str:
    """Resolve mode="auto" to "hash" or "range" from the input's estimated size."""
    if mode != "auto":
        return mode
    limit = int(df.sparkSession.conf.get("spark.driftlog.rangeFoldMinBytes", str(RANGE_FOLD_MIN_BYTES)))
    return "range" if estimated_bytes(df) >= limit else "hash"


# Target input bytes per range-fold partition (spark.driftlog.rangePartitionBytes).
RANGE_PARTITION_BYTES = 256 << 20
MAX_RANGE_PARTITIONS = 200_000


def range_partitions(df, requested: int | None = None) -> int:
    """Partition count for a range-partitioned fold: as requested, else enough partitions of
    about ``spark.driftlog.rangePartitionBytes`` for the input, never fewer than the shuffle
    partitions."""
    if requested:
        return int(requested)
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    est = estimated_bytes(df)
    if est >= (1 << 62):
        return base
    target = int(spark.conf.get("spark.driftlog.rangePartitionBytes", str(RANGE_PARTITION_BYTES)))
    return max(base, min(MAX_RANGE_PARTITIONS, -(-est // target)))
