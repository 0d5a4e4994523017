"""Sell-out reports of three retailers, each with its own layout, as one table by product, store and city."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import calendar, stores
from tallyhouse.functions.text import is_filled
from tallyhouse.operators.columns import column, complete, union_present
from tallyhouse.operators.periods import last_period
from tallyhouse.operators.reshape import filled_ids, nonzero, value_of_month
from tallyhouse.plans.sales import as_moment
from tallyhouse.schemas import require_columns

UNITS = "decimal(28,6)"
CITY_KEYS = ["EAN", "cliente", "Mes", "año", "Tienda", "Ciudad", "Descripcion"]


class NoHistory(ValueError):
    """A retailer without a month in the history: no month can be due."""


@dataclass(frozen=True)
class Period:
    """The month that is due."""

    year: int
    month: int

    @property
    def code(self) -> str:
        return rules.MONTH_CODES[self.month - 1]


def due_periods(history: DataFrame, clients=tuple(name for _, name in rules.RETAILERS)) -> dict[str, Period]:
    """The month that is due per client.

    Read here, one row per client of the list, because a known month lets the scan of a month matrix read one column.
    """
    due = last_period(history.filter(F.col("cliente").isin(*clients)))
    rows = due.select("cliente", "`siguiente_año`", "siguiente_mes").collect()
    found = {client: Period(year, rules.MONTH_CODES.index(code) + 1) for client, year, code in rows}
    missing = [client for client in clients if client not in found]
    if missing:
        raise NoHistory(f"no history for {missing}")
    return found


@dataclass(frozen=True)
class SellOut:
    """A report in the common columns: ``rows`` counts for the total, ``keyed`` (no null key) for the detail."""

    rows: DataFrame
    keyed: DataFrame
    client: str
    period: Period

    @property
    def sums(self) -> DataFrame:
        """Units by product, store and city, with their fractions."""
        units = F.col("Unidades").cast(UNITS)
        grouped = self.keyed.groupBy(*[F.col(f"`{key}`") for key in CITY_KEYS]).agg(
            F.coalesce(F.sum(units), F.lit(0)).cast(UNITS).alias("Unidades")
        )
        return grouped.withColumn("NumMes", F.lit(self.period.month))

    @property
    def detail(self) -> DataFrame:
        """Whole units by product, store and city."""
        return whole_units_of(self.sums)

    @property
    def summary(self) -> DataFrame:
        """One row: the units of the period."""
        return self._total(self.rows)

    def summary_of(self, sums: DataFrame) -> DataFrame:
        """The summary out of the written sums, where they hold all rows that count; else out of the report."""
        return self._total(sums) if self.rows is self.keyed else self.summary

    def _total(self, rows: DataFrame) -> DataFrame:
        units = F.sum(F.col("Unidades").cast(UNITS))
        return rows.agg(F.coalesce(units, F.lit(0)).cast("bigint").alias("Unidades")).select(
            F.lit(self.period.code).alias("Mes"),
            F.lit(self.period.year).alias("año"),
            F.lit(self.client).alias("cliente"),
            "Unidades",
            F.lit(self.period.month).alias("NumMes"),
        )


def whole_units_of(sums: DataFrame) -> DataFrame:
    return sums.withColumn("Unidades", F.col("Unidades").cast("bigint"))


def _rows(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(*[values[name].alias(name) for name in CITY_KEYS + ["Unidades"]])


def chain_rows(report: DataFrame) -> DataFrame:
    """The rows of the store chain that name a store."""
    return report.filter(is_filled(column(report, "Nomb. Dependencia")))


def chain(report: DataFrame | None, period: Period, client: str = rules.CHAIN) -> SellOut | None:
    """The store chain: a row per sale day; the month is the one of the sale. Null keys are not in the total either."""
    if report is None:
        return None
    require_columns(report, ["EAN", "Fecha", "Nomb. Dependencia", "Descripción", "Unidades"])
    named = chain_rows(report.withColumn("Fecha", as_moment(report, "Fecha")))
    named = complete(named, ["EAN", "Fecha", "Descripción"])
    named = named.withColumn("_place", stores.store_city_chain(column(named, "Nomb. Dependencia")))
    day, place = F.col("Fecha"), F.col("_place")
    rows = _rows(
        named,
        EAN=F.col("EAN").cast("string"),
        cliente=F.lit(client),
        Mes=calendar.month_name_english(day),
        año=F.year(day),
        Tienda=place["store"],
        Ciudad=place["city"],
        Descripcion=F.col("Descripción"),
        Unidades=F.col("Unidades"),
    )
    return SellOut(rows, rows, client, period)


def wholesale(matrix: DataFrame | None, period: Period, client: str = rules.WHOLESALER) -> SellOut | None:
    """The wholesaler: a month matrix, of which only the month that is due is read."""
    if matrix is None:
        return None
    require_columns(matrix, rules.MATRIX_IDS)
    store, _, text, barcode = rules.MATRIX_IDS
    # no column of the result can be null after these two filters
    filled = filled_ids(matrix, rules.MATRIX_IDS)
    filled = nonzero(filled.withColumn("_units", value_of_month(filled, period.month)), "_units")
    filled = filled.withColumn("_place", stores.without_code(column(filled, store)))
    filled = filled.withColumn("_place", stores.store_city_by_last_dash(F.col("_place")))
    place = F.col("_place")
    rows = _rows(
        filled,
        EAN=column(filled, barcode).cast("string"),
        cliente=F.lit(client),
        Mes=F.lit(rules.MONTH_NAMES[period.month - 1]),
        año=F.lit(period.year),
        Tienda=place["store"],
        Ciudad=place["city"],
        Descripcion=column(filled, text),
        Unidades=F.col("_units"),
    )
    return SellOut(rows, rows, client, period)


def pharmacy(report: DataFrame | None, period: Period, client: str = rules.PHARMACY) -> SellOut | None:
    """The pharmacy chain: store and city in columns of their own, no date."""
    if report is None:
        return None
    require_columns(report, ["UPC", "NOMBRE_TIENDA", "CIUDAD", "DESCRIPCION_ITEM", "UNIDADES_VENDIDAS"])
    rows = _rows(
        report,
        EAN=F.col("UPC").cast("string"),
        cliente=F.lit(client),
        Mes=F.lit(period.code),
        año=F.lit(period.year),
        Tienda=F.col("NOMBRE_TIENDA"),
        Ciudad=F.col("CIUDAD"),
        Descripcion=F.col("DESCRIPCION_ITEM"),
        Unidades=F.col("UNIDADES_VENDIDAS"),
    )
    return SellOut(rows, complete(rows, ["EAN", "Tienda", "Ciudad", "Descripcion"]), client, period)


def other_months(detail: DataFrame) -> DataFrame:
    """Detail rows of the store chain that are not of the month that is due."""
    return detail.filter(F.col("Mes") != F.element_at(F.array(*map(F.lit, rules.MONTH_NAMES_ENGLISH)), F.col("NumMes")))


def append_summaries(history: DataFrame, reports: list[SellOut | None]) -> DataFrame:
    return union_present([history] + [report.summary for report in reports if report is not None])


def append_details(history: DataFrame | None, reports: list[SellOut | None]) -> DataFrame | None:
    return union_present([history] + [report.detail for report in reports if report is not None])
