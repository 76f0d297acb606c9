"""Session settings shared by every entry point."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(app: str = "skyframe", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or fetch) a session; a cluster's own master and settings win unless given here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators rely on to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Python workers on this machine find the package wherever the driver was started; a cluster ships it itself.
    workers, here = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if here not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [here, workers.get("PYTHONPATH", "")]))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints: the session's ``spark.checkpoint.dir``, else the environment's
    ``SKYFRAME_CHECKPOINT_DIR``. Only a session whose executors all live in this process (master ``local``) may do without."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or os.environ.get("SKYFRAME_CHECKPOINT_DIR")
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").split("[")[0] == "local":
        return f"file://{os.environ.get('TMPDIR', '/tmp').rstrip('/')}/skyframe-{spark.sparkContext.applicationId}"
    raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder under the shared one that nothing else uses."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and still there when an executor is lost."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (never the executors' local disks)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)
