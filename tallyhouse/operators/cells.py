"""Clean a whole sheet: empty rows and columns, headers, cells, and the columns that turn out to be numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import canonical_key
from tallyhouse.operators.columns import column, drop_all_null_rows, normalize_headers, tidy_name
from tallyhouse.session import write_through

# the cast to double would read the suffixes d and f, and words such as Infinity, as well
_WHOLE = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"
# the first kind that fits all values of a column; a double holds 15 digits for sure, so longer numbers are decimals
_NUMBERS = (
    ("bigint", lambda cell: (F.length(cell) <= 19) & cell.rlike(_WHOLE) & ((F.length(cell) < 19) | cell.rlike(r"^[+-]"))),
    ("decimal(38,0)", lambda cell: (F.length(cell) <= 38) & cell.rlike(_WHOLE)),
    ("double", lambda cell: (F.length(cell) <= 15) & cell.rlike(_NUMBER)),
    ("decimal(38,18)", lambda cell: cell.rlike(r"^[+-]?(\d{1,20}(\.\d{0,18})?|\.\d{1,18})$")),
    ("double", lambda cell: cell.rlike(_NUMBER)),
)


def clean_cells(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every text cell in its compared form; the columns of ``keep`` and those that are not text pass."""
    kinds = dict(df.dtypes)
    names = [name for name in df.columns if name not in keep and kinds[name] == "string"]
    return df.withColumns({name: canonical_key(column(df, name)) for name in names})


def _number_tests(df: DataFrame, names: list[str]) -> list[Column]:
    """Per text column whether it has a value, and for each kind of number whether all its values are of it."""
    tests = [
        F.bool_and(column(df, name).isNull() | fits(column(df, name))).alias(f"kind{n}_{i}")
        for i, name in enumerate(names)
        for n, (_, fits) in enumerate(_NUMBERS)
    ]
    return tests + [F.bool_or(column(df, name).isNotNull()).alias(f"filled{i}") for i, name in enumerate(names)]


def _as_numbers(df: DataFrame, names: list[str], seen) -> DataFrame:
    """Cast the columns of ``names`` as the row of ``_number_tests`` allows."""
    casts = {}
    for i, name in enumerate(names):
        kind = next((kind for n, (kind, _) in enumerate(_NUMBERS) if seen[f"kind{n}_{i}"]), None)
        if seen[f"filled{i}"] and kind:
            casts[name] = column(df, name).cast(kind)
    return df.withColumns(casts)


def number_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A text column becomes a number if each of its values is one: whole numbers if all are whole.

    Whole numbers of more than 18 digits are decimals without places; other numbers are doubles, or, where one has more
    signs than a double holds digits, decimals of 20 digits and 18 places. Beyond these a column is a double and loses digits. A number has a sign, digits, a point and an exponent. The types of a plan must be known before it runs, so this
    runs one aggregate, of one row.
    """
    names = [name for name, kind in df.dtypes if kind == "string" and name not in keep]
    return _as_numbers(df, names, df.agg(*_number_tests(df, names)).first()) if names else df


def clean_table(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All of it; the columns of ``keep`` (such as the row order) pass untouched and do not make a row filled.

    The sheet is read once: its cells are written in their compared form, and one aggregate over them says which
    columns were filled and which are numbers.
    """
    kinds = dict(df.dtypes)
    body = [name for name in df.columns if name not in keep and kinds[name] != "void"]
    texts = [name for name in body if kinds[name] == "string"]
    rows = drop_all_null_rows(df, body)
    place = {name: f"c{i}" for i, name in enumerate(df.columns)}
    cells = [
        (canonical_key(column(rows, name)) if name in texts else column(rows, name)).alias(place[name])
        for name in df.columns
        if name in keep or name in body
    ]
    # a column of texts for "missing" is filled, although none of its cells is
    raw = [column(rows, name).isNotNull().alias(f"raw_{place[name]}") for name in texts]
    written = write_through(rows.select(*cells, *raw), "cells")
    there = {name: F.col(f"raw_{place[name]}") if name in texts else F.col(place[name]).isNotNull() for name in body}
    seen = written.agg(
        *_number_tests(written, [place[name] for name in texts]),
        *[F.bool_or(flag).alias(f"there_{place[name]}") for name, flag in there.items()],
    ).first()
    typed = _as_numbers(written, [place[name] for name in texts], seen)
    kept = [name for name in df.columns if name in keep or (name in body and seen[f"there_{place[name]}"])]
    named = typed.select(*[F.col(place[name]).alias(name) for name in kept])
    return normalize_headers(named, lambda name: name if name in keep else tidy_name(name))
