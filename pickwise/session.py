"""Session helpers: one place for the configuration the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every pickwise job wants regardless of cluster size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with their last reader
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  memory: str = "16g", app: str = "pickwise") -> SparkSession:
    """A local[N] session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.driver.memory", memory)
               .config("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; it is read from the session.
    Only a local-mode session without one (tests, the benchmark) gets a fresh
    scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running "
                           "iterative pickwise operators on a cluster")
    path = tempfile.mkdtemp(prefix="pickwise-ckpt-", dir=os.environ.get("PICKWISE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder; the files of the shuffles that made it are given back at once.
    Otherwise they stay until the driver's memory happens to be collected, beside all that come after."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan goes by the setting at its making
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
