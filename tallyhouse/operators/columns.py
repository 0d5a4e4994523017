"""Column lists and headers."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain_name(name: str) -> str:
    """Lower case, underscores for blanks, no accents, no points."""
    letters = unicodedata.normalize("NFKD", name.lower())
    bare = "".join(letter for letter in letters if not unicodedata.combining(letter))
    return bare.replace(" ", "_").replace(".", "")


def tidy_name(name: str) -> str:
    """Single blanks, and only word letters, blanks, points, dashes and underscores."""
    return re.sub(r"[^\w\s.\-]", "", re.sub(r"\s+", " ", name.strip()))


def normalize_headers(df: DataFrame, rule=plain_name) -> DataFrame:
    return df.toDF(*[rule(name) for name in df.columns])


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name, points included."""
    return df[f"`{name}`"]


def select_names(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[column(df, name) for name in names])


def insert_column(df: DataFrame, position: int, name: str, value: Column, keep: int | None = None) -> DataFrame:
    """Put ``value`` at ``position``; then keep the first ``keep`` columns."""
    columns = [column(df, c) for c in df.columns if c != name]
    columns.insert(position, value.alias(name))
    return df.select(*columns[:keep])


def drop_all_null_rows(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Drop the rows without any value in ``names`` (all columns by default)."""
    filled = [column(df, name).isNotNull() for name in names or df.columns]
    return df.filter(reduce(Column.__or__, filled))


def complete(df: DataFrame, names) -> DataFrame:
    """The rows with a value in each of ``names``. One condition per column, so that each can reach the scan."""
    return df.filter(reduce(Column.__and__, [column(df, name).isNotNull() for name in names]))


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without any value.

    The column list of a plan must be known before it runs, so this runs one aggregate, of one row.
    """
    seen = df.agg(*[F.bool_or(column(df, name).isNotNull()).alias(f"c{i}") for i, name in enumerate(df.columns)])
    flags = seen.first()
    return select_names(df, [name for name, flag in zip(df.columns, flags) if flag])


def union_present(frames: list[DataFrame | None]) -> DataFrame | None:
    """Append the frames that are there, by column name; a missing column is null. None if there are none."""
    present = [frame for frame in frames if frame is not None]
    if not present:
        return None
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), present)
