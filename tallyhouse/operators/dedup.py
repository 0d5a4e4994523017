"""One row per key, or per whole row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """The whole first row per key, by ``order``. Null keys are one group.

    ``min_by`` combines on the map side, so a key with many copies sends one row per task.
    """
    order = df[f"`{order}`"] if isinstance(order, str) else order
    row = F.struct(*[df[f"`{name}`"].alias(f"c{i}") for i, name in enumerate(df.columns)])
    firsts = df.groupBy(*[df[f"`{key}`"] for key in keys]).agg(F.min_by(row, order).alias("_row"))
    return firsts.select(*[F.col(f"_row.c{i}").alias(name) for i, name in enumerate(df.columns)])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
