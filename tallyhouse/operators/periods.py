"""Which period comes next, and whether a landed file fits it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import calendar
from tallyhouse.functions.text import is_filled
from tallyhouse.schemas import ROW_ORD

OK, NO_FILE, BAD_FORMAT, BAD_MONTH, WRONG_CLIENT = "ok", "no_file", "bad_format", "bad_month", "wrong_client"
NO_HISTORY, PROCESSED, UNEXPECTED = "no_history", "already_processed", "unexpected_month"


def unknown_months(history: DataFrame) -> DataFrame:
    """The rows whose month code is not one: rejects, left out of ``last_period``."""
    return history.filter(calendar.month_number_of_code(F.col("Mes")).isNull())


def last_period(history: DataFrame) -> DataFrame:
    """Per client the latest month with its units, the number of rows, and the month to come."""
    month = calendar.month_number_of_code(F.col("Mes"))
    order = [F.col("`año`").alias("y"), month.alias("m")] + ([F.col(ROW_ORD)] if ROW_ORD in history.columns else [])
    last = (
        history.filter(month.isNotNull())
        .groupBy("cliente")
        .agg(
            F.max_by(F.struct("Mes", "año", "Unidades", month.alias("month")), F.struct(*order)).alias("last"),
            F.count(F.lit(1)).alias("total_registros"),
        )
    )
    following = calendar.next_month(F.col("last.año"), F.col("last.month"))
    return last.select(
        "cliente",
        F.col("last.Mes").alias("ultimo_mes"),
        F.col("last.año").alias("ultimo_año"),
        F.concat_ws(" ", "last.Mes", "last.año").alias("fecha_completa"),
        F.col("last.Unidades").alias("unidades"),
        "total_registros",
        calendar.month_code(F.month(following)).alias("siguiente_mes"),
        F.year(following).alias("siguiente_año"),
    )


def file_name_gate(files: DataFrame, suffix: str = rules.LANDED_SUFFIX) -> DataFrame:
    """Add ``month`` and ``reason`` by the name rule ``MONTH_CLIENT``; the first check that fails names the reason."""
    bare = F.replace(F.col("file_name"), F.lit(suffix), F.lit(""))
    month = F.upper(F.split_part(bare, F.lit("_"), F.lit(1)))
    client = F.upper(F.substr(bare, F.instr(bare, "_") + F.lit(1)))
    reason = (
        F.when(~F.coalesce(is_filled(F.col("file_name")), F.lit(False)), NO_FILE)
        .when(~F.contains(bare, F.lit("_")), BAD_FORMAT)
        .when(~month.isin(*rules.MONTH_CODES), BAD_MONTH)
        .when(client != F.upper(F.col("client_key")), WRONG_CLIENT)
        .otherwise(OK)
    )
    return files.withColumn("reason", reason).withColumn("month", F.when(F.col("reason") == OK, month))


def period_reason(month, expected):
    """Compare month codes: same, already processed, or neither.

    If January is expected, the months of the second half of the year were processed.
    """
    found, wanted = calendar.month_number_of_code(month), calendar.month_number_of_code(expected)
    earlier = (found < wanted) | ((wanted == 1) & (found > 7))
    return F.when(found == wanted, OK).when(earlier, PROCESSED).otherwise(UNEXPECTED)


def period_gate(files: DataFrame, history: DataFrame, retailers=rules.RETAILERS) -> DataFrame:
    """One row per retailer and landed file: may it be processed, and if not, which check failed first.

    ``files`` has ``client_key`` and ``file_name``; a retailer without a file stays in the result.
    """
    spark = files.sparkSession
    names = spark.createDataFrame(list(retailers), "client_key string, client_name string")
    checked = file_name_gate(names.join(files, "client_key", "left"))
    periods = last_period(history).select(F.col("cliente").alias("client_name"), "siguiente_mes", "siguiente_año")
    gated = checked.join(periods, "client_name", "left")
    reason = (
        F.when(F.col("reason") != OK, F.col("reason"))
        .when(F.col("siguiente_mes").isNull(), NO_HISTORY)
        .otherwise(period_reason(F.col("month"), F.col("siguiente_mes")))
    )
    return gated.select(
        "client_key",
        "client_name",
        (reason == OK).alias("processable"),
        reason.alias("reason"),
        "file_name",
        "month",
        F.col("siguiente_mes").alias("expected_month"),
        F.col("siguiente_año").alias("expected_year"),
    )
