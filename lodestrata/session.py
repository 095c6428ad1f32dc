"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. AQE sizes broadcasts from real statistics, merges small
#: partitions and splits skewed join partitions; session windows are pre-merged map-side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "lodestrata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create a session with :data:`SETTINGS`; leave ``master`` unset on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where that is not set, only a session of one process (master ``local`` or ``local[n]``, as in tests) gets a
    folder of its own; anywhere else its files would be out of the other executors' reach, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lodestrata-"))
    return context.getCheckpointDir()


_stored: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared folder and read it back.

    The result survives lost executors, is computed once and, unlike a checkpoint of rows,
    stays columnar, so later steps read only the columns they use.
    """
    path = f"{shared_folder(df.sparkSession)}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _stored[stored] = path
    return stored


def release(stored: DataFrame) -> None:
    """Delete the table behind a result of :func:`cut_lineage` that nothing will read again."""
    path = _stored.pop(stored, None)
    if path:
        context = stored.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
