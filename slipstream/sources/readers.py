"""Reading landed files: seasons in one scan, feather on the executors, times as seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

DURATIONS = [
    "Time", "LapTime", "Sector1Time", "Sector2Time", "Sector3Time", "LapStartTime",
    "Sector1SessionTime", "Sector2SessionTime", "Sector3SessionTime", "PitInTime", "PitOutTime",
]


def existing_paths(spark: SparkSession, patterns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Paths that match the patterns, and the patterns that match nothing."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found, absent = [], []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        matches = path.getFileSystem(conf).globStatus(path)
        hits = [m.getPath().toString() for m in matches] if matches else []
        found += hits
        if not hits:
            absent.append(pattern)
    return found, absent


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    lenient: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Parquet files or folders as one scan. Unknown columns are an error.

    Without a ``schema`` every footer is read to merge theirs. ``lenient`` skips files that are gone or cannot be read, for
    scans over many rounds; `unreadable` lists them.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    if lenient:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return df if columns is None else require(df, columns)


def unreadable(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Paths of files that a lenient scan skips.

    Files that gave a row to such a scan are readable. Only of the others, broken or empty, the contents are looked at: a Parquet file begins
    and ends with its mark.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    name = F.regexp_replace(F.col("path"), "^[a-z]+:/*", "/")
    files = spark.read.format("binaryFile").load(paths)
    files = files.where(F.regexp_extract("path", "[^/]*$", 0).rlike("^[^_.]")).withColumn("file", name)
    scan = spark.read.schema("`__none` INT").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(*paths)
    good = scan.select(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/*", "/").alias("file")).distinct()
    # the driver lists the files of a scan anyway
    doubtful = [r["path"] for r in files.select("path", "file").join(good, "file", "left_anti").collect()]
    if not doubtful:
        return files.select("path").limit(0)
    magic = F.lit(b"PAR1")
    whole = (F.col("length") >= 12) & (F.substring("content", 1, 4) == magic) & (F.substring("content", -4, 4) == magic)
    return spark.read.format("binaryFile").load(doubtful).where(~whole).select("path")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns, or an error that lists what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def from_path(pattern: str, group: int = 1) -> Column:
    """A number taken from the file path of each row."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group).cast("int")


#: A year in the name of a file, not in the numbers and hashes that Spark names its own part files by.
SEASON_FILE = r"/(?!part-)[^/]*?(?<!\d)((?:19|20)\d{2})(?!\d)[^/]*$"


def read_seasons(spark: SparkSession, root: str, pattern: str = SEASON_FILE) -> DataFrame:
    """All season files under a folder in one scan.

    ``Season`` comes from the files or their ``Season=`` folders, so that a filter on it prunes folders. Only if neither has
    it, it is taken from the file name; a name without a season is an error.
    """
    by_folder, _ = existing_paths(spark, [f"{root.rstrip('/')}/Season=*"])
    reader = spark.read if by_folder else spark.read.option("recursiveFileLookup", "true")
    df = reader.parquet(root)
    if "Season" in df.columns:
        return df
    path = F.col("_metadata.file_path")
    year = F.regexp_extract(path, pattern, 1)
    none = F.raise_error(F.concat(F.lit("no season in the name of "), path)).cast("int")
    return df.withColumn("Season", F.when(year != "", year.cast("int")).otherwise(none))


def read_feather(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Feather (Arrow IPC) files, one task per file. Durations come out as seconds."""
    return decode_feather(spark.read.format("binaryFile").load(path), schema)


def decode_feather(files: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the feather files held in a ``content`` column, decoded on the executors.

    The schema is taken from one file when not given.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.feather as feather

    def plain(table: pa.Table) -> pa.Table:
        """Durations to seconds, timestamps to microseconds, dictionaries to their values."""
        for i, f in enumerate(table.schema):
            column = table.column(i)
            if pa.types.is_duration(f.type):
                nanos = column.cast(pa.duration("ns")).cast(pa.int64())
                column = pc.divide(nanos.cast(pa.float64()), 1e9)
            elif pa.types.is_timestamp(f.type):
                column = column.cast(pa.timestamp("us", tz="UTC"), safe=False)
            elif pa.types.is_dictionary(f.type):
                column = column.cast(f.type.value_type)
            elif pa.types.is_large_string(f.type):
                column = column.cast(pa.string())
            table = table.set_column(i, f.name, column)
        return table

    if schema is None:
        def describe(batches):
            for batch in batches:
                for content in batch.column("content"):
                    fields = plain(feather.read_table(pa.BufferReader(content.as_buffer()))).schema
                    yield pa.RecordBatch.from_arrays([pa.array([fields.serialize().to_pybytes()], pa.binary())], ["schema"])

        # a file is read where it lies; only its schema comes here
        first = files.select("content").limit(1).mapInArrow(describe, "schema binary").head()
        if first is None:
            raise FileNotFoundError("no feather files")
        schema = from_arrow_schema(pa.ipc.read_schema(pa.BufferReader(first[0])))
    wanted = to_arrow_schema(schema)

    def decode(batches):
        for batch in batches:
            for content in batch.column("content"):
                table = plain(feather.read_table(pa.BufferReader(content.as_buffer())))
                yield from table.select(wanted.names).cast(wanted).to_batches()

    return files.select("content").mapInArrow(decode, schema)


def read_lookup(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A small table kept by hand, as CSV with a header."""
    reader = spark.read.option("header", "true")
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def seconds(nanos: Column) -> Column:
    """A duration that arrives as whole nanoseconds, in seconds."""
    return nanos / F.lit(1e9)


def durations_to_seconds(df: DataFrame, columns: Sequence[str] = DURATIONS) -> DataFrame:
    """Bring duration columns to seconds: whole nanoseconds are divided, doubles are seconds already."""
    types = dict(df.dtypes)
    nanos = [c for c in columns if types.get(c) == "bigint"]
    return df.withColumns({c: seconds(F.col(c)) for c in nanos}) if nanos else df


def nanos_to_timestamp(nanos: Column) -> Column:
    """A nanosecond timestamp that was read as a whole number."""
    return F.timestamp_micros((nanos / 1000).cast("long"))


def read_laps(spark: SparkSession, root: str) -> DataFrame:
    """Lap files of all seasons, times in seconds and dates as timestamps."""
    df = durations_to_seconds(read_seasons(spark, root))
    if dict(df.dtypes).get("EventDate") == "bigint":
        df = df.withColumn("EventDate", nanos_to_timestamp(F.col("EventDate")))
    return df
