"""One function per job. Each takes loaded tables and output folders and returns what it wrote and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.operators.columns import union_present
from tallyhouse.operators.resume import resume_point, resume_point_at
from tallyhouse.functions import calendar
from tallyhouse.operators.periods import unknown_months
from tallyhouse.plans import costs, customers, rfm, sales, sellout, weekly
from tallyhouse.schemas import ROW_ORD, whole_number
from tallyhouse.session import write_through
from tallyhouse.sources import sinks, versions
from tallyhouse.sources.catalog import SalesTables, SellOutTables


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written, instead of in a second pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _rows(observation: Observation) -> int:
    """The count; a branch that the optimizer found to be empty reports none."""
    return observation.get.get("rows", 0)


def _rejected(df: DataFrame | None, name: str, out: str, inputs) -> int:
    """Write rejects and count them; nothing for a source that has no text."""
    if df is None:
        return 0
    counted, count = _counted(df, name)
    sinks.write_parquet(counted, f"{out}/{name}", inputs)
    return _rows(count)


def cast_like(df: DataFrame, other: DataFrame) -> DataFrame:
    """Give the columns that both have the types of ``other``; text becomes a whole number as the typing reads it."""
    kinds, own = {field.name: field.dataType for field in other.schema}, dict(df.dtypes)
    differing = [name for name in df.columns if name in kinds and own[name] != kinds[name].simpleString()]

    def cast(name):
        value, kind = F.col(f"`{name}`"), kinds[name].simpleString()
        return whole_number(value) if (own[name], kind) == ("string", "bigint") else value.cast(kind)

    return df.withColumns({name: cast(name) for name in differing})


def next_batch(new: DataFrame, history: DataFrame, known: list[versions.Version] | None = None) -> DataFrame:
    """Put the new rows after the history in the row order; ``known`` versions say where it ends without a scan."""
    kind = new.schema[ROW_ORD].dataType.simpleString()
    if not kind.startswith("struct") or "batch" not in kind:
        return new
    if known:
        marks = versions.marks_of(known)
        last = F.lit(marks.batch if marks else None).cast("bigint")
    else:
        last = history.agg(F.max(f"{ROW_ORD}.batch")).scalar()
    return new.withColumn(ROW_ORD, F.col(ROW_ORD).withField("batch", F.coalesce(last, F.lit(0)) + 1))


def refresh_sales(
    tables: SalesTables, out: str, cutoff: str = rules.SALES_CUTOFF, inputs=(), append_to: str | None = None
) -> dict:
    """Append the new, enriched sales. Nothing is written when there is nothing new or the marker is missing.

    With ``append_to``, the folder of the history, only the new rows are written: the work of a refresh then grows with
    the export and not with the history, whose end its manifest knows (the first append makes one). Without it a
    new table is written.
    """
    if tables.new is None:
        return {"status": "no_file", "sales": tables.history}
    rule, spark = sales.marker_rule(), tables.new.sparkSession
    known = None
    if append_to is not None:
        known = versions.versions_of(spark, append_to) or versions.adopt(spark, append_to, rule.date, rule.keys)
    landed = write_through(next_batch(tables.new, tables.history, known), "landed")
    # found once: the plans below get the place and the date as literals, and do not search the history again
    ordered = known and not any(v.unordered for v in known)
    found = resume_point_at(landed, rule, versions.marks_of(known)) if ordered else resume_point(landed, tables.history, rule)
    status = {name: found[name] for name in ("status", "history_date", "marker_date", "new_rows")}
    status["untyped"] = _rejected(tables.untyped, "sales_untyped", out, inputs)
    status["dropped_columns"] = sales.dropped_columns(landed)
    if status["status"] != "new_rows":
        return {**status, "sales": tables.history}
    fresh = sales.after_point(landed, found)
    added, count = _counted(cast_like(sales.enrich_sales(fresh, cutoff), tables.history), "added")
    sinks.write_parquet(sales.without_units(fresh), f"{out}/sales_without_units", inputs)
    refreshed = union_present([tables.history, added])
    if append_to is None:
        path = sinks.write_parquet(refreshed, f"{out}/sales", inputs)
    else:
        sinks.append_parquet(added, append_to, rule.date, rule.keys)
        return {**status, "added": _rows(count), "sales": versions.read_versions(spark, append_to, schema=refreshed.schema)}
    written = spark.read.schema(refreshed.schema).parquet(path)
    return {**status, "added": _rows(count), "sales": written}


def dedup_customers(tables: SalesTables, out: str, inputs=()) -> dict:
    if tables.customers is None:
        return {"status": "no_file"}
    result, count = _counted(customers.dedup_customers(tables.customers), "customers")
    sinks.write_parquet(result, f"{out}/customers", inputs)
    return {"status": "ok", "customers": _rows(count)}


def count_purchases(refreshed: DataFrame, out: str, inputs=()) -> dict:
    """On the refreshed sales, or on the history where nothing was refreshed."""
    result, count = _counted(weekly.weekly_purchase_count(refreshed), "weeks")
    sinks.write_parquet(result, f"{out}/weekly_purchases", inputs)
    return {"status": "ok", "rows": _rows(count)}


def consolidate_costs(tables: SalesTables, out: str, year: int = rules.COST_YEAR, inputs=(), drop_later_years: bool = False) -> dict:
    if tables.costs_history is None or tables.family is None:
        return {"status": "no_file"}
    result = costs.consolidate_costs(tables.costs_history, tables.costs_new, tables.family, year, drop_later_years=drop_later_years)
    result, count = _counted(result, "costs")
    sinks.write_parquet(result, f"{out}/costs", inputs)
    return {"status": "ok", "rows": _rows(count), "untyped": _rejected(tables.untyped_costs, "costs_untyped", out, inputs)}


def refresh_all(
    tables: SalesTables, out: str, cutoff: str, year: int, inputs=(), append_to: str | None = None, drop_later_years: bool = False
) -> dict:
    """Sales, customers, weekly counts and costs, in this order."""
    sales_result = refresh_sales(tables, out, cutoff, inputs, append_to)
    refreshed = sales_result.pop("sales")
    return {
        "sales": sales_result,
        "customers": dedup_customers(tables, out, inputs),
        "weekly": count_purchases(refreshed, out, inputs),
        "costs": consolidate_costs(tables, out, year, inputs, drop_later_years),
    }


def consolidate_sellout(tables: SellOutTables, out: str, inputs=()) -> dict:
    """The summary and the city table, each with the admitted reports appended."""
    reports = [report for report in tables.reports if report is not None]
    # each report is read once: its sums are small, and mostly hold the total too
    sums = [write_through(report.sums, "detail") for report in reports]
    details = [sellout.whole_units_of(rows) for rows in sums]
    summaries = [report.summary_of(rows) for report, rows in zip(reports, sums)]
    sinks.write_parquet(union_present([tables.history, *summaries]), f"{out}/sellout", inputs)
    cities = union_present([tables.cities, *details])
    if cities is not None:
        sinks.write_parquet(cities, f"{out}/sellout_cities", inputs)
    late = union_present([sellout.other_months(rows) for report, rows in zip(reports, details) if report.client == rules.CHAIN])
    return {
        "reports": len(reports),
        "gate": [row.asDict() for row in tables.gate.collect()],
        "failures": tables.failures,
        "untyped": {key: _rejected(df, f"untyped_{key.lower()}", out, inputs) for key, df in tables.rejects.items()},
        "other_months": _rejected(late, "other_months", out, inputs),
        "unknown_months": _rejected(unknown_months(tables.history), "unknown_months", out, inputs),
    }


def segment_customers(
    raw_sales: DataFrame,
    raw_customers: DataFrame,
    out: str,
    as_of: str | None = None,
    channels=rules.CHANNELS,
    inputs=(),
    formats=calendar.ISO,
    one_per_tax_id: bool = True,
    on_ties: str = "compare",
) -> dict:
    """The segments as Parquet and as text; the sales without a customer name, with their number and revenue; and the
    sales whose date or amount cannot be read."""
    # the raw sales are read once: what is written has both the clean rows and the texts of those that cannot be read
    tagged = write_through(rfm.tagged_sales(raw_sales, formats), "clean_sales")
    clean = tagged.drop(rfm.UNREAD)
    register = write_through(rfm.clean_customers(raw_customers, one_per_tax_id), "register")
    unmatched = Observation("unmatched")
    without_name = rfm.sales_without_name if one_per_tax_id else rfm.unmatched_customers
    rejects = without_name(clean, register).observe(
        unmatched, F.count(F.lit(1)).alias("rows"), F.sum(rfm.cents(F.col("valor_bruto_local"))).alias("cents")
    )
    sinks.write_parquet(rejects, f"{out}/sales_without_customer", inputs)
    segments, count = _counted(rfm.rfm_segments(rfm.daily_revenue_of(clean, register), as_of, channels, on_ties), "segments")
    sinks.write_parquet(segments, f"{out}/segments", inputs)
    written = segments.sparkSession.read.schema(segments.schema).parquet(f"{out}/segments")
    sinks.write_csv(written, f"{out}/segments_csv", inputs)
    return {
        "segments": _rows(count),
        "sales_without_customer": _rows(unmatched),
        "revenue_without_customer": (unmatched.get.get("cents") or 0) / 100,
        "untyped": _rejected(rfm.unread_sales(tagged), "sales_untyped", out, inputs),
    }
