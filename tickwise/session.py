"""Session helpers.

The library never creates its own cluster settings beyond what a query needs:
it reads the shared checkpoint folder from the session (``spark.checkpoint.dir``)
and only falls back to a scratch folder when none is configured (tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that keep results reproducible and plans adaptive. Everything else
# (memory, executors) belongs to the cluster manager, not to the library.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a given input size and cluster.

    * file splits of ``target_partition_bytes`` (scan tasks fit executor memory);
    * an initial shuffle partition count that keeps every shuffle partition at
      or below the target even before AQE (rounded to a multiple of the cores,
      at least 2 waves); AQE then coalesces small partitions to the advisory
      size and splits skewed ones (skew join).
    E.g. 100 TB on 8,000 cores -> ~400k initial partitions, 256 MB each.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tickwise") -> SparkSession:
    """A local session for tests and the bench (single JVM)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.ansi.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors "
                             "(e.g. on HDFS or an object store); a machine-local folder does not survive "
                             "executor loss")
        # local mode (tests): a scratch folder on the only machine
        configured = tempfile.mkdtemp(prefix="tickwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickwise`` importable in executor Python workers (once per application).

    Pandas UDFs / ``mapInPandas`` functions reference package modules; the
    package is zipped on the driver and distributed by Spark (``addPyFile``),
    which is what a cluster needs when the library is not installed on the
    executors' images.  Harmless when it is.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        fd, zpath = tempfile.mkstemp(prefix="tickwise-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, names in os.walk(pkg):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(d, n)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(zpath)
        _SHIPPED.add(app)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tickwise-tables", name)
