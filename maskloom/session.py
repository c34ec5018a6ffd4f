"""Session set-up and the reliable checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "maskloom", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    n = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``checkpoint()`` writes to the shared folder named by the session.

    Only a local session without the setting gets a temporary folder; a cluster
    session without it is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="spark-ckpt-")
    sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` over all shuffle partitions of the session. As the number is told, AQE does not merge them into a few large tasks; groups and joins by these keys need no more exchange."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def share_code(spark: SparkSession) -> None:
    """Put the folder of this package on the path of Python workers, for use without an installed wheel on hosts that share it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
