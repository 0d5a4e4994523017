"""Writers. A table goes to a folder of its own; the folder of an input is refused."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources import versions
from tallyhouse.sources.versions import UnorderedTable

__all__ = ["UnorderedTable", "append_parquet", "read_range", "write_csv", "write_parquet", "write_sorted"]

#: Beside the files of a sorted table: which keys each of them holds.
RANGES = "_ranges"


def _checked(path: str, inputs: Iterable[str | None]) -> str:
    if path.rstrip("/") in {source.rstrip("/") for source in inputs if source}:
        raise ValueError(f"{path} is an input of the job; write a new version next to it")
    return path


def write_parquet(df: DataFrame, path: str, inputs: Iterable[str | None] = ()) -> str:
    """Write a new table; fails if the folder is there already."""
    df.write.mode("errorifexists").parquet(_checked(path, inputs))
    return path


def append_parquet(df: DataFrame, path: str, date: str | None = None, keys: versions.Keys | None = None) -> versions.Version:
    """Add rows to a table as a new version of it; see ``versions.append_version``.

    If the new rows have an order, all rows must: read without one, old rows would sort after new ones. The manifest knows.
    """
    return versions.append_version(df, path, date, keys)


def write_sorted(df: DataFrame, path: str, keys: list[str], files: int | None = None, inputs: Iterable[str | None] = ()) -> str:
    """Write a new table in the order of ``keys``: over the files by their names, and inside each of them.

    Cut by ranges of all keys, so that equal first keys may share several files; rows with equal keys meet in one. A small table
    beside the files says which keys each holds, for ``read_range``. ``files`` is the number of ranges, by default that of
    shuffle partitions; ranges without rows have no file.
    """
    spark = df.sparkSession
    ranges = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(f"`{key}`") for key in keys]
    df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns).write.mode("errorifexists").parquet(_checked(path, inputs))
    written = spark.read.schema(df.schema).parquet(path)
    first = F.col(f"`{keys[0]}`")
    held = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(first).alias("least"), F.max(first).alias("greatest"), F.count_if(first.isNull()).alias("nulls")
    )
    held.write.parquet(f"{path}/{RANGES}")
    return path


def read_range(spark: SparkSession, path: str, key: str, least, greatest) -> DataFrame:
    """The rows of a sorted table with ``least <= key <= greatest``, its first key: files without such rows are not opened."""
    held = spark.read.parquet(f"{path}/{RANGES}").filter((F.col("least") <= F.lit(greatest)) & (F.col("greatest") >= F.lit(least)))
    names = [row["file"] for row in held.select("file").orderBy("file").collect()]  # of the range that is asked for
    value = F.col(f"`{key}`")
    table = spark.read.parquet(path)
    if not names:
        return table.limit(0)
    return spark.read.schema(table.schema).parquet(*[f"{path}/{name}" for name in names]).filter(value.between(F.lit(least), F.lit(greatest)))


def write_csv(df: DataFrame, path: str, inputs: Iterable[str | None] = ()) -> str:
    """The same as delimited text with a header line per file."""
    df.write.mode("errorifexists").option("header", True).csv(_checked(path, inputs))
    return path
