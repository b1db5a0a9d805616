"""Writing results: partitioned parquet, CSV reports, metrics as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = ("Season",)) -> None:
    """Parquet, one folder per partition value; rows are gathered by it first so folders hold few files."""
    if by:
        # a season larger than the advised partition size is split again by the adaptive planner
        df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header. The number of files follows the data; reports are small."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def metrics_frame(spark: SparkSession, metrics: dict) -> DataFrame:
    """A dictionary of metrics (numbers, texts, nested lists or dictionaries) as one row."""
    from pyspark.sql import Row

    return spark.createDataFrame([Row(**metrics)])


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    metrics_frame(spark, metrics).write.mode("overwrite").json(path)


def write_bytes(spark: SparkSession, data: bytes, path: str) -> None:
    """A small file as it is, wherever Spark can write."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data))
    out.close()


def write_feather(df: DataFrame, path: str) -> None:
    """Feather files written by the tasks that hold the rows, into a folder that executors reach as a file system of Arrow's
    (a shared mount, HDFS, an object store)."""
    schema = to_arrow_schema(df.schema)

    def land(batches):
        import pyarrow as pa
        import pyarrow.feather as feather
        from pyarrow import fs

        rows = list(batches)  # one partition is one file, which a repeated task writes again
        if rows:
            store, folder = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":", "://", 1))
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/part-{TaskContext.get().partitionId():05d}.feather") as out:
                feather.write_feather(pa.Table.from_batches(rows).cast(schema), out)
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(r.num_rows for r in rows)], pa.int64())})

    df.mapInArrow(land, "n bigint").agg({"n": "sum"}).collect()
