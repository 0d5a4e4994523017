"""Left joins against a reference table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEY_SLICES = 1024


def left_lookup(facts: DataFrame, table: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Left outer join on one key where a null key finds nothing.

    Null keys are spread by a hash of the whole row instead of meeting in one task; the other hot keys are split by
    AQE's skew join. The join strategy is left to AQE, which knows the measured size of ``table``.
    ``keep`` names columns of ``table`` to take; all but the key by default.
    """
    names = list(keep) or [name for name in table.columns if name != key]
    fact_key = facts[f"`{key}`"]
    spread = F.pmod(F.xxhash64(*[facts[f"`{name}`"] for name in facts.columns]), F.lit(NULL_KEY_SLICES))
    left = facts.withColumn("_slice", F.when(fact_key.isNull(), spread).otherwise(F.lit(0).cast("bigint")))
    right = table.select(
        table[f"`{key}`"].alias("_key"),
        F.lit(0).cast("bigint").alias("_slice_of_table"),
        *[table[f"`{name}`"] for name in names],
    )
    on: Column = (left[f"`{key}`"] == right["_key"]) & (left["_slice"] == right["_slice_of_table"])
    return left.join(right, on, "left").drop("_slice", "_key", "_slice_of_table")


def exclude_values(df: DataFrame, name: str, values: tuple[str, ...]) -> DataFrame:
    """Drop the rows whose value is listed, and the rows without a value. Compared as text."""
    value = df[f"`{name}`"].cast("string")
    return df.filter(value.isNotNull() & ~value.isin(*values))
