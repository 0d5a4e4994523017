"""Product costs: the history with its product family, and the costs of the month that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import calendar
from tallyhouse.operators.columns import column, select_names, union_present
from tallyhouse.operators.lookup import left_lookup
from tallyhouse.schemas import require_columns

BRAND, FLAG = "Marca", "Incluir referencia(Si/No)"
CARRIED = ["Referencia", "Desc.item", "Instalación", "U.M.", "Costo prom.", "Mes", "Año"]
OUTPUT = CARRIED + [BRAND, FLAG]


def costs_with_family(history: DataFrame, family: DataFrame) -> DataFrame:
    """Add brand and flag from the family table, falling back to the history's own."""
    require_columns(history, CARRIED)
    require_columns(family, ["Referencia"])
    own = history.withColumn("Referencia", F.col("Referencia").cast("string"))
    names = [name for name in (BRAND, FLAG) if name in family.columns]
    table = family.select(
        F.col("Referencia").cast("string").alias("Referencia"),
        *[column(family, name).alias(f"family {name}") for name in names],
    )
    joined = left_lookup(own, table, "Referencia")

    def value(name):
        found = [joined[f"`{n}`"] for n in (f"family {name}", name) if n in joined.columns]
        return (F.coalesce(*found) if found else F.lit(None).cast("string")).alias(name)

    return joined.select(*[column(joined, name) for name in CARRIED], value(BRAND), value(FLAG))


def next_cost_period(history: DataFrame, year: int = rules.COST_YEAR) -> DataFrame:
    """One row: are there rows of ``year``, and which month and year follow its last month."""
    last = history.filter(F.col("Año") == year).agg(
        F.count(F.lit(1)).alias("rows"), F.max(calendar.month_number_of_name(F.col("Mes"))).alias("month")
    )
    goes_on = F.coalesce(F.col("month") < 12, F.lit(False))
    return last.select(
        "rows",
        F.when(goes_on, F.col("month") + 1).otherwise(1).alias("next_month"),
        F.when(goes_on, year).otherwise(year + 1).alias("next_year"),
    )


def new_costs(new: DataFrame, history: DataFrame, year: int = rules.COST_YEAR) -> DataFrame:
    """The input rows of the next month, or of the whole year if the history has none of it."""
    renamed = new.withColumnsRenamed({"Costo prom. uni.": "Costo prom.", "Desc. item": "Desc.item"})
    renamed = select_names(require_columns(renamed, CARRIED + [BRAND]), CARRIED + [BRAND])
    renamed = renamed.withColumn("Referencia", F.col("Referencia").cast("string"))
    period = next_cost_period(history, year)
    following = period.select(F.struct("rows", "next_month", "next_year")).scalar()
    fits = (calendar.month_number_of_name(F.col("Mes")) == following["next_month"]) & (
        F.col("Año") == following["next_year"]
    )
    chosen = F.when(following["rows"] == 0, F.col("Año") == year).otherwise(fits)
    return renamed.filter(chosen).withColumn(FLAG, F.lit(None).cast("string"))


def consolidate_costs(
    history: DataFrame,
    new: DataFrame | None,
    family: DataFrame,
    year: int = rules.COST_YEAR,
    drop_later_years: bool = False,
) -> DataFrame:
    """The history with its family, and the new costs of the period that follows.

    Without new costs the history comes back as it is. ``drop_later_years`` leaves out the history after ``year``
    when new rows are appended.
    """
    if new is None:
        return history
    known, added = costs_with_family(history, family), new_costs(new, history, year)
    if drop_later_years:
        counts = added.agg(F.count(F.lit(1))).scalar()
        in_year = next_cost_period(history, year).select("rows").scalar()
        known = known.filter((F.col("Año") <= year) | ((counts == 0) & (in_year > 0)))
    return union_present([known, added])
