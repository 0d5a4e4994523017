"""Customer register: one row per tax id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import strip
from tallyhouse.operators.dedup import first_by_key
from tallyhouse.schemas import ROW_ORD, require_columns


def dedup_customers(customers: DataFrame, key: str = "nit", order: str = ROW_ORD) -> DataFrame:
    """Trim the tax id and keep the first row of each; the rows without one count as one customer."""
    require_columns(customers, [key, order])
    trimmed = customers.withColumn(key, strip(F.col(key).cast("string")))
    return first_by_key(trimmed, [key], order)
