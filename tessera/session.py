"""Session construction and cluster-facing settings.

The builder here is what tests, ``bench.py`` and command-line use share.  On a
cluster the session normally comes from the submitter; every helper in the
library takes the session as given and only *reads* settings from it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution (coalescing small shuffle
# partitions, splitting skewed join partitions, switching to broadcast when
# the *measured* side is small), UTC timestamps so results do not depend on
# the host, and Arrow for the few pandas-backed operators.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``shuffle_partitions`` defaults to the core count for local runs; on a
    cluster pass a value sized so one shuffle partition is ~128-256 MB.
    """
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is None:
        shuffle_partitions = int(os.environ.get("TESSERA_SHUFFLE_PARTITIONS", "8"))
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    on a local master (tests, a laptop) is a private folder created; on a
    cluster a machine-local folder would be wrong (executors would write to
    their own disks), so the setting is required there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths``, from the file system's
    listing (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_partitions(spark: SparkSession, total_input_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Size shuffles and file splits for an input of ``total_input_bytes``.

    Shuffle partitions start at about one per ``target_bytes`` of input (at
    least twice the cores), so a partition of a full-input shuffle fits an
    executor's memory without heavy spill; AQE then coalesces small ones
    toward the same advisory size and splits skewed ones.  File splits use
    the same target.  Returns the shuffle partition count it set."""
    cores = spark.sparkContext.defaultParallelism
    n = max(2 * cores, -(-total_input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    return n


def materialize(df):
    """Write ``df`` once as a reliable checkpoint in the shared checkpoint
    folder and return the frame that reads it back.

    Used where several branches of one plan must see *the same* partitions,
    for example rows numbered after a range-partitioned sort: two separate
    range exchanges sample their own bounds and can split the data
    differently, while every reader of a checkpoint sees identical
    partitions, also after an executor is lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df):
    """Write ``df`` once as a table in the shared checkpoint folder and return
    the frame that reads it.  As :func:`materialize`, but the frame keeps no
    constraints of the plan behind it: in loops that rename columns those
    multiply each round and planning takes longer than the rounds."""
    import uuid

    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
