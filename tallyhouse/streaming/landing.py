"""Enrich sales files as they land, each once.

The enrichment looks at one row at a time, so the batch plan runs on a stream as it is. What a stream has done is kept
beside its output, under the output's own name: it belongs to the output, and not to a session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyhouse import rules, schemas
from tallyhouse.plans import sales


def landed_sales(spark: SparkSession, folder: str, columns: list[str], files_per_batch: int = 1000) -> DataFrame:
    """Delimited sales files with the given header, typed."""
    known = {name: kind for name, kind in schemas.SALES.items() if name in columns}
    return schemas.apply_types(_landed(spark, folder, columns, files_per_batch), known)


def rejected_sales(spark: SparkSession, folder: str, columns: list[str], files_per_batch: int = 1000) -> DataFrame:
    """The landed rows, as text, that the enrichment leaves out: units missing, or a filled cell that does not fit."""
    raw = _landed(spark, folder, columns, files_per_batch)
    known = {name: kind for name, kind in schemas.SALES.items() if name in columns}
    unread = schemas.untyped_cell(raw, known) | sales.whole_units(raw).isNull()
    return raw.filter(unread)


def _landed(spark: SparkSession, folder: str, columns: list[str], files_per_batch: int) -> DataFrame:
    return (
        spark.readStream.schema(schemas.text_schema(columns))
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def _started(df: DataFrame, out: str, name: str) -> StreamingQuery:
    writer = df.writeStream.format("parquet").queryName(name).trigger(availableNow=True)
    return writer.option("checkpointLocation", f"{out.rstrip('/')}.checkpoint").start(out)


def enrich_landed(
    spark: SparkSession, folder: str, columns: list[str], out: str, name: str, cutoff: str = rules.SALES_CUTOFF
) -> StreamingQuery:
    """Process the files that are there now and stop. A later start with the same output takes only newer files."""
    return _started(sales.enrich_sales(landed_sales(spark, folder, columns), cutoff), out, name)


def reject_landed(spark: SparkSession, folder: str, columns: list[str], out: str, name: str) -> StreamingQuery:
    """The same for the rows that the enrichment leaves out, into an output of their own."""
    return _started(rejected_sales(spark, folder, columns), out, name)
