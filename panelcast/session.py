"""Session construction and cluster-safe checkpointing."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins/aggregates from measured
# shuffle sizes (runtime broadcast, partition coalescing, skew splitting).
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (e.g. 1000 executors over ~100 TB); pass as
# ``extra=CLUSTER_CONF`` or set in the cluster's defaults. AQE picks the
# reducer count from measured shuffle sizes (target ~256 MB per partition,
# starting from a high ceiling), scans split at 512 MB, skewed join
# partitions (> 5x the median and > 1 GB) are split, and small join sides
# are broadcast from measured sizes only up to 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "panelcast",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs and tests; on a cluster use the provided session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf and master.startswith("local"):
        # local runs only: a cluster session names a shared folder itself
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="panelcast-ckpt-")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be on shared storage and is taken from the
    session. Only when the setting is absent (local tests) a fresh scratch
    folder is created and recorded in the session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: configure a shared folder for checkpoints on the cluster")
        path = tempfile.mkdtemp(prefix="panelcast-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) into the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    Like a checkpoint it survives lost executors and cuts the lineage. It also
    leaves behind the constraints that a checkpointed frame keeps of its old plan, which the
    optimizer multiplies for every renamed column (50 s of planning over 44 features).
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``panelcast`` importable in Python workers (``mapInPandas``
    closures reference its helpers): the package is zipped once per
    application and distributed with ``addPyFile``, as ``--py-files`` would."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    target = os.path.join(tempfile.mkdtemp(prefix="panelcast-pkg-"), "panelcast.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    zf.write(path, os.path.relpath(path, root))
    sc.addPyFile(target)
    _SHIPPED.add(app)
