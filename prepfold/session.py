"""Session helpers.

The library itself never builds a session: every operator takes a DataFrame
and returns a DataFrame. These helpers are for tests, the bench and the
examples, and for finding the shared folder a cluster names for lineage cuts
and model files.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "prepfold") -> SparkSession:
    """A local session configured like the tests and bench expect.

    AQE stays on so the runtime can coalesce partitions, split skewed join
    partitions and turn a sort-merge join into a broadcast join when a side
    turns out small (a size-checked broadcast). The UI is off.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise on sparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster (``spark.checkpoint.dir``), or
    the one set on the context at run time."""
    value = spark.conf.get(CHECKPOINT_KEY, None)
    if value:
        return value
    sc = _context(spark)
    if sc is None:
        return None
    value = sc.getConf().get(CHECKPOINT_KEY, None)
    return value or sc.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` and is shared
    storage; without it this raises instead of falling back to a folder
    that only one machine can see. Only a local-mode session without the
    setting (tests, bench) gets a fresh scratch folder, set on the context
    (``spark.checkpoint.dir`` itself cannot change after start-up).
    """
    sc = _context(spark)
    path = checkpoint_dir(spark)
    if not path:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (model files, "
                               "tree checkpoints and stream state are written there)")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="prepfold-ckpt-"))
        return sc.getCheckpointDir()
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (model files, cut tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                max_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster job over ``input_bytes``.

    The shuffle partition count is chosen so an average shuffle partition
    holds about ``target_partition_bytes`` if the whole input were shuffled
    (AQE coalesces smaller ones at run time), never fewer than two waves of
    tasks over ``total_cores``. Scan splits are ``max_partition_bytes``.
    Skew handling and broadcast conversion stay with AQE.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
    }
