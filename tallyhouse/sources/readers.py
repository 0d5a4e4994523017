"""Text and Parquet tables as DataFrames with their file order.

``row_ord`` is a struct (batch, file, block, place) and compares field by field: the load, the file, the part of the
file that a task read, and the row's place in that part. It needs no shuffle and no sort. For text files the place is
known only while the file is read, so the landing step writes the rows once.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import rules, schemas
from tallyhouse.functions import calendar, text
from tallyhouse.operators.reshape import LEVEL
from tallyhouse.schemas import ROW_ORD
from tallyhouse.session import write_through
from tallyhouse.sources import versions

TEXT_ENDINGS = (".csv", ".txt")


class UnreadableMatrix(ValueError):
    """A month matrix whose files differ in their header lines."""


@dataclass(frozen=True)
class Dialect:
    """How delimited files are written. ``line_breaks`` reads line breaks in quoted cells, a file in one task."""

    sep: str = ","
    encoding: str = "UTF-8"
    date_formats: tuple[str, ...] = calendar.ISO
    line_breaks: bool = False

    def reader(self, spark: SparkSession):
        options = spark.read.option("header", True).option("sep", self.sep).option("encoding", self.encoding)
        return options.option("multiLine", self.line_breaks).option("escape", '"')


PLAIN = Dialect()


def _row_ord(batch: int, block: Column, place: Column) -> Column:
    return F.struct(
        F.lit(batch).cast("bigint").alias("batch"),
        F.col("_metadata.file_path").alias("file"),
        block.cast("bigint").alias("block"),
        place.cast("bigint").alias("place"),
    )


def _as_list(df: DataFrame) -> list[Column]:
    return [df[f"`{name}`"] for name in df.columns]


def read_text_table(spark: SparkSession, path: str, batch: int = 0, dialect: Dialect = PLAIN) -> DataFrame:
    """A delimited file with a header line: every cell as text, and ``row_ord``."""
    raw = dialect.reader(spark).csv(path)
    place = _row_ord(batch, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return raw.select(*_as_list(raw), place.alias(ROW_ORD))


def read_typed(
    spark: SparkSession, path: str, schema: dict[str, str], batch: int = 0, dialect: Dialect = PLAIN
) -> DataFrame:
    """A delimited file, its cells typed by ``schema``; other columns stay text."""
    return schemas.apply_types(read_text_table(spark, path, batch, dialect), schema, dialect.date_formats)


def read_parquet(spark: SparkSession, path: str, batch: int = 0) -> DataFrame:
    """A Parquet table; rows that carry no order yet get the order of their files. Of a table with a manifest, the rows
    of its committed versions."""
    raw = versions.read_versions(spark, path) if versions.has_versions(spark, path) else spark.read.parquet(path)
    if ROW_ORD in raw.columns:
        return raw
    place = _row_ord(batch, F.lit(0), F.col("_metadata.row_index"))
    return raw.select(*_as_list(raw), place.alias(ROW_ORD))


def read_table(
    spark: SparkSession, path: str, schema: dict[str, str] | None = None, batch: int = 0, dialect: Dialect = PLAIN
) -> DataFrame:
    """By the ending of ``path``: a delimited file, else Parquet."""
    if path.lower().endswith(TEXT_ENDINGS):
        return read_typed(spark, path, schema, batch, dialect) if schema else read_text_table(spark, path, batch, dialect)
    return read_parquet(spark, path, batch)


def read_optional(
    spark: SparkSession, path: str | None, schema: dict[str, str] | None = None, dialect: Dialect = PLAIN
) -> DataFrame | None:
    """None for a source that is not there."""
    return None if path is None else read_table(spark, path, schema, dialect=dialect)


def read_untyped(
    spark: SparkSession, path: str | None, schema: dict[str, str], dialect: Dialect = PLAIN
) -> DataFrame | None:
    """The rows of a text source with a cell that does not fit its type; None for a typed source."""
    if path is None or not path.lower().endswith(TEXT_ENDINGS):
        return None
    return schemas.untyped_rows(read_text_table(spark, path, dialect=dialect), schema, dialect.date_formats)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def landed_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder as a table: file_name, size, modified. Their content is not read; folders in it are no files."""
    listed = spark.read.format("binaryFile").load(folder)
    return listed.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified"),
    )


def flat_headers(upper: list[str], lower: list[str]) -> list[str]:
    """Two header lines as one: ``month|measure``. An empty upper cell belongs to the one before it."""
    names, last = [], ""
    for top, bottom in zip(upper, lower):
        last = top.strip() or last
        names.append(f"{last}{LEVEL}{bottom.strip()}" if bottom.strip() else last)
    return names


def read_month_matrix(
    spark: SparkSession,
    path: str,
    preamble: int = rules.MATRIX_PREAMBLE_LINES,
    headers: int = rules.MATRIX_HEADER_LINES,
    ids=rules.MATRIX_IDS,
    dialect: Dialect = PLAIN,
) -> tuple[DataFrame, DataFrame]:
    """Delimited files with lines before the header and two header lines: (rows, rejects).

    Cells below two header lines are numbers, with a decimal comma or point. The rejects are the rows with a filled cell that
    is none, and those with a cell too many, as text. Files of one folder must have the same header; a line whose
    quotes do not close (a line break in a cell) is an error. The lines of a file's first block are counted from the
    least place of the file, one number per file, so that no line is sorted or moved.
    """
    lines = spark.read.option("encoding", dialect.encoding).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    # a task reads a block from its start to its end, so the places of its lines follow each other
    starts = lines.filter(F.col("block") == 0).groupBy("file").agg(F.min("place").alias("start"))
    starts = write_through(starts.withColumn("block", F.lit(0).cast("bigint")), "starts")
    numbered = lines.join(starts, ["file", "block"], "left").withColumn("line", F.col("place") - F.col("start") + 1)
    top = numbered.filter(F.col("line").between(preamble + 1, preamble + headers))
    found = top.groupBy("line", "value").agg(F.count(F.lit(1)).alias("files")).orderBy("line").limit(headers + 1).collect()
    if len(found) != headers:
        raise UnreadableMatrix(f"{path}: {len(found)} different header lines instead of {headers}")
    names = flat_headers(*csv.reader([row.value for row in found], delimiter=dialect.sep))
    # lines of later blocks have no number
    body = numbered.filter(F.coalesce(F.col("line") > preamble + headers, F.lit(True))).select("value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    torn = F.raise_error(F.concat(F.lit("a cell with a line break in a month matrix: "), F.col("value")))
    whole = body.filter(text.is_filled(F.col("value"))).select(F.when(quotes % 2 == 1, torn).otherwise(F.col("value")).alias("value"))
    cells = [f"c{i}" for i in range(len(names))]
    ddl = ", ".join(f"{cell} string" for cell in [*cells, "more"])
    # a generator, since a filter on its cells does not parse the line once more below it
    parsed = whole.select(F.inline(F.array(F.from_csv("value", ddl, {"sep": dialect.sep, "escape": '"'}))))
    bad, typed = F.col("more").isNotNull(), []
    for cell, name in zip(cells, names):
        value = F.col(cell)
        if name not in ids and LEVEL in name:
            value = text.decimal_comma(text.strip(value), 28, 6)
            bad = bad | (text.is_filled(F.col(cell)) & value.isNull())
        typed.append(value.alias(name))
    rejects = parsed.filter(bad).select(*[F.col(c).alias(n) for c, n in zip(cells, names)], F.col("more").alias("_more"))
    return parsed.filter(F.col("more").isNull()).select(*typed), rejects
