"""The inputs of a job by name. Everything is read lazily: a table that no plan uses costs nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import rules, schemas
from tallyhouse.operators.periods import period_gate
from tallyhouse.plans import sellout
from tallyhouse.sources import readers

CHAIN_KEY, WHOLESALE_KEY, PHARMACY_KEY = (key for key, _ in rules.RETAILERS)


@dataclass(frozen=True)
class SalesTables:
    """Inputs of the sales, customer and cost jobs; ``untyped`` are new sales with a date or amount that is none."""

    history: DataFrame
    new: DataFrame | None
    customers: DataFrame | None
    costs_history: DataFrame | None
    costs_new: DataFrame | None
    family: DataFrame | None
    untyped: DataFrame | None = None
    untyped_costs: DataFrame | None = None


def load_sales_tables(
    spark: SparkSession,
    history: str,
    new: str | None = None,
    customers: str | None = None,
    costs_history: str | None = None,
    costs_new: str | None = None,
    family: str | None = None,
    dialect: readers.Dialect = readers.PLAIN,
) -> SalesTables:
    return SalesTables(
        readers.read_table(spark, history, _sales_types(), dialect=dialect),
        readers.read_optional(spark, new, _sales_types(rejected_later=("Cantidad inv.",)), dialect),
        readers.read_optional(spark, customers, dialect=dialect),
        readers.read_optional(spark, costs_history, schemas.COSTS_HISTORY, dialect),
        readers.read_optional(spark, costs_new, schemas.COSTS_NEW, dialect),
        readers.read_optional(spark, family, {"Referencia": "string"}, dialect),
        readers.read_untyped(spark, new, _sales_types(rejected_later=("Cantidad inv.",)), dialect),
        readers.read_untyped(spark, costs_new, schemas.COSTS_NEW, dialect),
    )


def _sales_types(rejected_later: tuple[str, ...] = ()) -> dict[str, str]:
    """The columns that need a type; ``rejected_later`` stay text, so that the rejects show what was in the file."""
    names = {name: kind for name, kind in schemas.SALES.items() if kind != "string" or name in rules.MARKER_KEYS}
    return names | {name: "string" for name in rejected_later}


@dataclass(frozen=True)
class SellOutTables:
    """The history, the verdict per retailer, and the reports of the admitted ones."""

    history: DataFrame
    cities: DataFrame | None
    gate: DataFrame
    reports: list[sellout.SellOut | None]
    rejects: dict[str, DataFrame]
    failures: dict[str, str]


def load_sellout_tables(
    spark: SparkSession,
    history: str,
    cities: str | None,
    folder: str,
    files: dict[str, str | None],
    dialect: readers.Dialect = readers.PLAIN,
) -> SellOutTables:
    """``files`` maps the retailer keys to file names in ``folder``; see ``newest_reports``.

    The gate decides what is read, so its result, one row per retailer, is read here. A report is known by the name
    without the workbook ending, as text or Parquet. A report that is not there, lacks columns or has a header that
    cannot be read is left out, with the reason in ``failures``; the others go on.
    """
    past = readers.read_table(spark, history, schemas.SELLOUT_HISTORY, dialect=dialect)
    named = [(key, files.get(key)) for key, _ in rules.RETAILERS]
    landed = spark.createDataFrame(named, "client_key string, file_name string")
    gate = period_gate(landed.withColumn("file_name", _workbook_name()), past)
    verdicts = {row.client_key: row for row in gate.collect()}

    def admitted(key):
        verdict = verdicts.get(key)
        if verdict is None or not verdict.processable:
            return None, None
        month = rules.MONTH_CODES.index(verdict.expected_month) + 1
        return f"{folder.rstrip('/')}/{files[key]}", sellout.Period(verdict.expected_year, month)

    rejects: dict[str, DataFrame | None] = {}
    failures: dict[str, str] = {}

    def typed(schema, plan):
        def load(key, path, period):
            rejects[key] = readers.read_untyped(spark, path, schema, dialect)
            return plan(readers.read_table(spark, path, schema, dialect=dialect), period)

        return load

    def matrix(key, path, period):
        rows, rejects[key] = readers.read_month_matrix(spark, path, dialect=dialect)
        return sellout.wholesale(rows, period)

    # units with fractions are summed with them, as the reports count
    units = {"Unidades": "decimal(28,6)"}
    loaders = {
        CHAIN_KEY: typed(schemas.SELLOUT_CHAIN | units, sellout.chain),
        WHOLESALE_KEY: matrix,
        PHARMACY_KEY: typed(schemas.SELLOUT_PHARMACY | {"UNIDADES_VENDIDAS": "decimal(28,6)"}, sellout.pharmacy),
    }
    reports = []
    for key, load in loaders.items():
        path, period = admitted(key)
        if path is None:
            continue
        if not readers.exists(spark, path):
            failures[key] = "no such file"
            continue
        try:
            reports.append(load(key, path, period))
        except (schemas.MissingColumns, readers.UnreadableMatrix) as error:
            rejects.pop(key, None)
            failures[key] = str(error)
    kept = {key: df for key, df in rejects.items() if df is not None}
    past_cities = readers.read_optional(spark, cities, schemas.SELLOUT_CITY, dialect)
    return SellOutTables(past, past_cities, gate, reports, kept, failures)


def newest_reports(spark: SparkSession, folder: str) -> dict[str, str | None]:
    """Retailer key -> the newest file in the folder whose name ends with it, before the ending; None without one.

    What is read here is one name per retailer; the gate then decides whether it may be read.
    """
    bare = F.regexp_replace("file_name", r"(?i)\.(csv|txt|parquet)$", "")
    keys = F.create_map(*[F.lit(part) for key, _ in rules.RETAILERS for part in (key.upper(), key)])
    landed = readers.landed_folder(spark, folder).withColumn("bare", F.upper(bare))
    named = landed.withColumn("client_key", keys[F.substr("bare", F.instr("bare", "_") + F.lit(1))])
    latest = named.filter("client_key is not null").groupBy("client_key").agg(F.max_by("file_name", F.struct("modified", "file_name")).alias("file_name"))
    found = {row["client_key"]: row["file_name"] for row in latest.collect()}
    return {key: found.get(key) for key, _ in rules.RETAILERS}


def _workbook_name() -> Column:
    return F.regexp_replace("file_name", r"\.(csv|txt|parquet)$", rules.LANDED_SUFFIX)
