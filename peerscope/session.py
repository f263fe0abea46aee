"""Session helpers: building a local session for tests/bench and cutting lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every peerscope job relies on; applied only when a caller builds the session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "peerscope") -> SparkSession:
    """A local session for tests and the benchmark (clusters bring their own session)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a folder that all executors share; without it
    this raises, since intermediate tables in machine-local folders would be read back in part.
    Only a local session (tests, bench), whose one process has one file system, gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="peerscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


#: Spark's own setting: an execution's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _writers = threading.Lock(), {}


@contextmanager
def shuffles_removed(spark: SparkSession):
    """While open, each execution's shuffle files are removed at its end, not whenever the driver collects garbage.
    Nested and concurrent uses of a session share it; the last one out restores the setting."""
    key = id(spark._jsparkSession)
    with _writing:
        n, before = _writers.get(key, (0, None))
        if n == 0:
            before = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _writers[key] = n + 1, before
    try:
        yield
    finally:
        with _writing:
            n, before = _writers.pop(key)
            if n > 1:
                _writers[key] = n - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read it back.

    This truncates the plan (later self-joins analyse a small tree), computes the input
    once (unlike an unpersisted ``checkpoint()``, which runs its job twice) and leaves a
    table in the shared folder that survives executor loss.  The shuffle files of the write are
    of no more use then and go with it.
    """
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/peerscope/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
