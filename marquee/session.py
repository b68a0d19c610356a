"""Session helpers.

Library code never creates a session itself; these helpers are for
scripts, tests and the bench.  ``shared_dir`` is how every job finds a
place for checkpoints and intermediate tables: the cluster names it in
``spark.checkpoint.dir``; only when that is unset (local runs, tests) do we
set one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "marquee") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "8g"))
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if not os.environ.get("MARQUEE_CHECKPOINT_DIR"):
        own = tempfile.mkdtemp(prefix="marquee-ckpt-")
    else:
        own = os.environ["MARQUEE_CHECKPOINT_DIR"]
    builder = builder.config(CHECKPOINT_CONF, own).config("spark.sql.warehouse.dir", f"{own}/warehouse")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


_OWN_DIRS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``.  If the session has none (local
    mode, tests), create one once per SparkContext and register it as the
    RDD checkpoint dir, so ``DataFrame.checkpoint()`` works too.  On a
    cluster without the setting this is an error.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    key = id(sc)
    if key not in _OWN_DIRS:
        _OWN_DIRS[key] = tempfile.mkdtemp(prefix="marquee-ckpt-")
        sc.setCheckpointDir(_OWN_DIRS[key])
    return _OWN_DIRS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (never a machine-local temp)."""
    return f"{shared_dir(spark)}/marquee/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input with ``total_cores`` cores.

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (at least two per core) and AQE coalesces the small ones at run time;
    scans split files into ``partition_bytes`` pieces; skewed join
    partitions are split; a side is broadcast only under the stated
    threshold (measured by the planner); streams keep state in RocksDB with
    changelog checkpoints.  Pass the result to ``SparkSession.builder.config``
    or ``spark-submit --conf``.
    """
    partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
