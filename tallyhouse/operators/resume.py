"""Find where a new export goes on after the rows that are already in the history.

The marker is the last row of the history by ``row_ord``; what follows its first match in the export is new.
The marker and its place are scalar subqueries: two small aggregates, no sort, and the place reaches the scan as a
filter on ``row_ord``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import ROW_ORD

Keys = Callable[[DataFrame], dict[str, Column]]


@dataclass(frozen=True)
class ResumeRule:
    """``keys`` builds the values that are compared, cheap ones first; ``date`` names the column that bounds the search."""

    keys: Keys
    date: str
    order: str = ROW_ORD


def last_row(history: DataFrame, value: Column, order: str = ROW_ORD) -> DataFrame:
    """``value`` of the last row. Reads the order column first, then only the row groups that can hold its maximum.

    A struct order is not compared in the scan, but its first field, the batch, is.
    """
    kind = history.schema[order].dataType
    if isinstance(kind, T.StructType):
        batch = f"{order}.{kind.names[0]}"
        history = history.filter(F.col(batch) == history.agg(F.max(batch)).scalar())
    last = history.agg(F.max(order)).scalar()
    return history.filter(F.col(order) == last).agg(F.first(value).alias("value"))


def at_or_after_history(new: DataFrame, history: DataFrame, date: str) -> DataFrame:
    """The rows not older than the newest row of the history."""
    newest = history.agg(F.max(F.col(f"`{date}`"))).scalar()
    return new.filter(F.col(f"`{date}`") >= newest)


def marker_place(new: DataFrame, history: DataFrame, rule: ResumeRule) -> DataFrame:
    """One row: ``place``, the ordinal of the first row that equals the marker, or null."""
    known = F.struct(*[value.alias(name) for name, value in rule.keys(history).items()])
    marker = last_row(history, known, rule.order).scalar()
    candidates = at_or_after_history(new, history, rule.date)
    equal = [value.eqNullSafe(marker[name]) for name, value in rule.keys(candidates).items()]
    # an empty history has no marker, and a row of nulls must not stand for it
    return candidates.filter(reduce(Column.__and__, equal, marker.isNotNull())).agg(F.min(rule.order).alias("place"))


def rows_after_marker(new: DataFrame, history: DataFrame, rule: ResumeRule) -> DataFrame:
    """The new rows; none if the marker is not found."""
    place = marker_place(new, history, rule).scalar()
    return at_or_after_history(new, history, rule.date).filter(F.col(rule.order) > place)


def resume_point(new: DataFrame, history: DataFrame, rule: ResumeRule) -> dict:
    """``resume_status`` as a dictionary, with ``place`` and ``newest`` (the history's date): one row, read here.

    Place and date are small and fixed from now on, so that later plans take them as literals.
    """
    place = marker_place(new, history, rule).scalar()
    status = resume_status(new, history, rule)
    return status.select("*", place.alias("place"), F.col("history_date").alias("newest")).first().asDict(recursive=True)


def resume_point_at(new: DataFrame, rule: ResumeRule, marks) -> dict:
    """``resume_point`` where the history's end is known (``versions.Marks``, or None for an empty history): the new rows
    are read, the history is not."""
    date = F.col(f"`{rule.date}`")
    kind = new.schema[rule.date].dataType.simpleString()
    if marks is None or not marks.marker:
        nothing = {"status": "marker_missing", "history_date": None, "marker_date": None, "new_rows": 0, "place": None, "newest": None}
        return nothing if marks is None else nothing | {"newest": new.limit(0).agg(marks.newest_date(kind)).first()[0]}
    candidates = new.filter(date >= marks.newest_date(kind))
    equal = [value.eqNullSafe(marks.literal(name)) for name, value in rule.keys(candidates).items()]
    place = candidates.filter(reduce(Column.__and__, equal)).agg(F.min(rule.order).alias("place")).scalar()
    after = candidates.agg(F.count_if(F.col(rule.order) > place).alias("new_rows"))
    status = F.when(place.isNull(), "marker_missing").when(F.col("new_rows") == 0, "nothing_new").otherwise("new_rows")
    ends = [marks.newest_date(kind).alias("history_date"), F.lit(marks.last_date).cast(kind).alias("marker_date")]
    found = after.select(status.alias("status"), *ends, "new_rows", place.alias("place"), marks.newest_date(kind).alias("newest"))
    return found.first().asDict(recursive=True)


def resume_status(new: DataFrame, history: DataFrame, rule: ResumeRule) -> DataFrame:
    """One row: ``status`` (marker_missing, nothing_new, new_rows), both dates and the number of new rows."""
    date = F.col(f"`{rule.date}`")
    place = marker_place(new, history, rule).scalar()
    after = at_or_after_history(new, history, rule.date).agg(
        F.count_if(F.col(rule.order) > place).alias("new_rows")
    )
    status = (
        F.when(place.isNull(), "marker_missing").when(F.col("new_rows") == 0, "nothing_new").otherwise("new_rows")
    )
    return after.select(
        status.alias("status"),
        history.agg(F.max(date)).scalar().alias("history_date"),
        last_row(history, date, rule.order).scalar().alias("marker_date"),
        F.col("new_rows"),
    )
