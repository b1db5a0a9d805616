"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for results (time zone, nanosecond columns) or for plan shape (AQE, and
# letting a join reuse a partitioning on a subset of its keys instead of shuffling again).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("slipstream")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # small local inputs still use every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # recording the Python call site of every column costs more than building the column
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets
    a temporary folder of its own: on a cluster a machine-local folder would be lost with its node.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="slipstream-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint in the shared folder: later branches read the same stored rows."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder beside the shared checkpoints, which goes when the driver's JVM ends."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def staged(df, name: str, *more):
    """Write a frame that several branches read to the shared folder, and read it back.

    Unlike a checkpoint the stored copy is columnar, so each branch reads only its own columns. The
    folder is new on every call and goes when the driver's JVM ends, or before by `discard`. The rows of ``more``
    frames with the same columns are added to it, each by a plan of its own: a union would be one plan of them all.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    for part in (df, *more):
        if part.dtypes != df.dtypes:
            raise ValueError(f"the frames of {name} differ in their columns")
        part.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def growing(df):
    """A side of a join that grows with the input: it is shuffled, never sent to the driver and broadcast.

    The optimizer goes by the size of the stored files, and compressed columns are many times smaller than their rows.
    """
    return df.hint("merge")


def discard(df) -> None:
    """Delete the stored rows of a staged frame that nothing reads any more."""
    spark = df.sparkSession
    shared = checkpoint_folder(spark).split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(shared):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
