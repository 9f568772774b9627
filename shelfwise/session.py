"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. AQE picks join strategies from measured sizes
# and splits skewed join partitions, so no operator hard-codes a broadcast hint.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long cleaning projections compile to methods the JVM would only interpret: above this size
    # Spark splits them into small methods instead (measured: half the time on two million rows).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Pages are large: bound what one Arrow batch of them holds.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(app_name: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``, or one in the warehouse if it is unset.

    A warehouse on the driver's own disk serves a local session only: on a cluster it is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if own_disk(warehouse) and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a shared folder: the warehouse lies on the driver's disk")
        folder = f"{warehouse}/_shelfwise"
    context.setCheckpointDir(folder)


def own_disk(path: str) -> bool:
    """Whether a path lies on one machine's disk, as far as its scheme tells."""
    return path.startswith("file:") or "://" not in path


def shared_folder(spark: SparkSession) -> str:
    """A new path in the checkpoint folder, for tables handed from one job to the next."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


_STAGING: list[str] = []


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of handed-over tables."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """What is stored inside the block goes to one folder, which is removed at its end."""
    folder = shared_folder(spark)
    _STAGING.append(folder)
    try:
        yield folder
    finally:
        _STAGING.remove(folder)
        discard(spark, folder)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, or that of the surrounding ``staging`` block, and read it back.

    This cuts the lineage like a checkpoint, but evaluates ``df`` once, and later readers
    prune columns and filter in the scan.
    """
    path = f"{_STAGING[-1]}/{uuid.uuid4().hex}" if _STAGING else shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
