"""From a month matrix to rows. Matrix columns are named ``month|measure``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions.text import is_filled
from tallyhouse.operators.columns import column

LEVEL = "|"


def matrix_columns(df: DataFrame, measure: str = rules.MATRIX_MEASURE) -> dict[str, str]:
    """Month name in lower case to the column that holds ``measure``."""
    pairs = [name.split(LEVEL, 1) for name in df.columns if LEVEL in name]
    return {month.strip().lower(): f"{month}{LEVEL}{what}" for month, what in pairs if what == measure}


def filled_ids(df: DataFrame, ids) -> DataFrame:
    """The rows where every id column that is there is filled."""
    for name in ids:
        if name in df.columns:
            df = df.filter(is_filled(column(df, name)))
    return df


def nonzero(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull() & (F.col(name) != 0))


def unpivot_months(df: DataFrame, ids, measure: str = rules.MATRIX_MEASURE) -> DataFrame:
    """One row per id row and month: the ids, ``Mes`` in lower case and ``Unidades``. Empty and zero cells go."""
    months = matrix_columns(df, measure)
    wide = filled_ids(df, ids).select(
        *[column(df, name) for name in ids], *[column(df, name).alias(month) for month, name in months.items()]
    )
    return nonzero(wide.unpivot([column(wide, name) for name in ids], list(months), "Mes", "Unidades"), "Unidades")


def value_of_month(df: DataFrame, month_number: int, measure: str = rules.MATRIX_MEASURE) -> Column:
    """The matrix cell of one month, null if the matrix has no such column. The scan reads no other month."""
    name = matrix_columns(df, measure).get(rules.MONTH_NAMES[month_number - 1])
    return F.lit(None).cast("bigint") if name is None else column(df, name)
