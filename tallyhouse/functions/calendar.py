"""Dates, weeks and months. Timestamps carry no zone (``TIMESTAMP_NTZ``), so no session zone can move them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions.text import strip

ISO = None  # no format list: the ISO spellings that a cast reads, which is several times faster than a pattern


def _lookup(pairs) -> Column:
    return F.create_map(*[F.lit(part) for pair in pairs for part in pair])


def parse_timestamp(text: Column, formats: tuple[str, ...] | None = ISO) -> Column:
    """The first format that fits wins; a text that fits none becomes null."""
    text = strip(text.cast("string"))
    if formats is ISO:
        return text.try_cast("timestamp_ntz")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def parse_timestamp_strict(text: Column, formats: tuple[str, ...] | None = ISO) -> Column:
    """The same, but a filled text that fits no format fails the job."""
    parsed = parse_timestamp(text, formats)
    message = F.concat(F.lit("not a date: "), text.cast("string"))
    return F.when(parsed.isNull() & text.isNotNull(), F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)


def moment(value: str | date | datetime | None = None) -> Column:
    """A literal point in time; the current date if none is given."""
    return F.lit(str(date.today() if value is None else value)).cast("timestamp_ntz")


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down (half a day back is -1)."""
    later, earlier = later.cast("timestamp_ntz"), earlier.cast("timestamp_ntz")
    time_later = later - later.cast("date").cast("timestamp_ntz")
    time_earlier = earlier - earlier.cast("date").cast("timestamp_ntz")
    return F.datediff(later.cast("date"), earlier.cast("date")) - (time_later < time_earlier).cast("int")


def week_start(day: Column) -> Column:
    """The Monday of the week."""
    return F.trunc(day.cast("date"), "week")


def month_name(day: Column, names=rules.MONTH_NAMES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.month(day))


def month_name_english(day: Column) -> Column:
    return month_name(day, rules.MONTH_NAMES_ENGLISH)


def month_number_text(day: Column) -> Column:
    return F.lpad(F.month(day).cast("string"), 2, "0")


def month_number_of_code(code: Column) -> Column:
    """``ENE`` … ``DIC`` to 1 … 12; null for anything else."""
    return _lookup((code_, i) for i, code_ in enumerate(rules.MONTH_CODES, 1))[code]


def month_number_of_name(name: Column) -> Column:
    """A full month name in any case to 1 … 12; null for anything else."""
    return _lookup((name_, i) for i, name_ in enumerate(rules.MONTH_NAMES, 1))[F.lower(strip(name))]


def month_code(number: Column) -> Column:
    return _lookup(enumerate(rules.MONTH_CODES, 1))[number.cast("int")]


def month_full_name(code: Column) -> Column:
    """``ENE`` … ``DIC`` to ``Enero`` … ``Diciembre``."""
    return _lookup((c, n.capitalize()) for c, n in zip(rules.MONTH_CODES, rules.MONTH_NAMES))[code]


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def next_month(year: Column, month: Column) -> Column:
    """The first day of the month after; December rolls over into the next year."""
    return F.add_months(first_of_month(year, month), 1)
