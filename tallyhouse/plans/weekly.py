"""Purchases per week, market line and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import calendar
from tallyhouse.operators.columns import complete
from tallyhouse.plans.sales import as_moment

OPTIONAL_KEYS = ("Linea de mercado", "Razon social")


def weekly_purchase_count(sales: DataFrame) -> DataFrame:
    """Rows per week. Year and month are those of the week's Monday; rows with a null key do not count."""
    keys = [name for name in OPTIONAL_KEYS if name in sales.columns]
    monday = calendar.week_start(as_moment(sales, "Fecha"))
    weeks = complete(sales.select(monday.alias("Semana"), *[F.col(f"`{name}`") for name in keys]), ["Semana", *keys])
    counted = weeks.groupBy("Semana", *keys).agg(F.count(F.lit(1)).alias("numCompras"))
    return counted.select(
        F.year("Semana").cast("string").alias("Año"),
        calendar.month_name(F.col("Semana")).alias("Mes"),
        "Semana",
        calendar.month_number_text(F.col("Semana")).alias("Mes_num"),
        *keys,
        "numCompras",
    )
