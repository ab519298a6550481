"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lookups need no sort where every partition of the lookup side is found to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Prospectus HTML is large: bound what one Arrow batch holds by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}

# On a cluster: many small reduce tasks, which adaptive execution merges up to the advisory size.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    # What is broadcast is small, but it can take a pass over a large table to find it.
    "spark.sql.broadcastTimeout": "7200",
}


def build_session(app: str = "greenshoe", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``_`` for ``.`` in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    on_cluster = not (master or "").startswith("local")
    settings = SETTINGS | (CLUSTER_SETTINGS if on_cluster else {})
    settings |= {name.replace("_", "."): value for name, value in extra.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="greenshoe-"))
        folder = context.getCheckpointDir()
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several passes need the same expensive rows. Unlike a cache it survives the loss
    of executors, and later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
