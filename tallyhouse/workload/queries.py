"""One query per operator: (session, data folder) to DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse import rules, schemas
from tallyhouse.functions import calendar, products, stores, text
from tallyhouse.operators import cells, columns, periods, reshape, resume
from tallyhouse.operators.dedup import distinct_rows
from tallyhouse.operators.lookup import exclude_values
from tallyhouse.plans import costs, customers, rfm, sales, sellout, weekly
from tallyhouse.session import scratch_path
from tallyhouse.sources import catalog, readers, sinks, versions
from tallyhouse.workload import tables as roles
from tallyhouse.workload.tables import AS_OF, COST_YEAR, CUTOFF, SEGMENT_CHANNELS, Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name; result columns get plain names, timestamps become dates."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(function(Tables(spark, folder)))

    QUERIES[function.__name__] = run
    return function


def plain(df: DataFrame) -> DataFrame:
    named = columns.normalize_headers(df, lambda name: re.sub(r"\W+", "_", columns.plain_name(name)).strip("_"))
    return named.withColumns({n: F.col(n).cast("date") for n, kind in named.dtypes if kind.startswith("timestamp")})


# ------------------------------------------------------------------ segmentation
def _daily(t: Tables) -> DataFrame:
    return rfm.daily_revenue(roles.order_sales(t))


def _metrics(t: Tables) -> DataFrame:
    return rfm.rfm_metrics(_daily(t), AS_OF, SEGMENT_CHANNELS)


def _clean(t: Tables) -> tuple[DataFrame, DataFrame]:
    return rfm.clean_sales(roles.line_sales(t)), rfm.clean_customers(roles.customer_register(t))


@query
def rfm_segments(t):
    return rfm.rfm_segments(_daily(t), AS_OF, SEGMENT_CHANNELS)


@query
def rfm_scores(t):
    return rfm.rfm_scores(_metrics(t)).drop("cents")


@query
def rfm_metrics(t):
    return _metrics(t).withColumn("monetary", F.col("cents") / F.lit(100000.0)).drop("cents")


@query
def rfm_metrics_of_channels(t):
    """A channel list that leaves channels out."""
    metrics = rfm.rfm_metrics(_daily(t), AS_OF, SEGMENT_CHANNELS[:2])
    return metrics.withColumn("monetary", F.col("cents") / F.lit(100000.0)).drop("cents")


@query
def daily_revenue(t):
    return _daily(t).withColumn("revenue_miles", F.col("cents") / F.lit(100000.0)).drop("cents")


@query
def quintile_cuts(t):
    return rfm.quintile_cuts(_metrics(t)).withColumn("cut", F.round("cut", 6))


@query
def frequency_rank(t):
    return rfm.frequency_rank(_metrics(t)).select("canal", "customer_id", "purchase_dates", "rank")


@query
def segment_lookup(t):
    digits = [
        F.substring("o_orderpriority", 1, 1).cast("int"),
        1 + F.dayofmonth("o_orderdate") % 5,
        F.weekday("o_orderdate"),
    ]
    scored = t.orders.select((digits[0] * 100 + digits[1] * 10 + digits[2]).alias("score"))
    counted = scored.groupBy("score").agg(F.count(F.lit(1)).alias("orders"))
    return counted.withColumn("categoria", rfm.segment_of(F.col("score")))


@query
def rfm_inputs(t):
    return _clean(t)[0]


@query
def rfm_customers(t):
    return _clean(t)[1]


@query
def rfm_end_to_end(t):
    return rfm.segment_customers(roles.line_sales(t), roles.customer_register(t), AS_OF, SEGMENT_CHANNELS)


@query
def sales_with_customer(t):
    return rfm.sales_with_customer(*_clean(t))


@query
def unmatched_customers(t):
    return rfm.unmatched_customers(*_clean(t))


@query
def tax_id_root(t):
    raw = roles.line_sales(t)
    return raw.groupBy(text.tax_id_root(F.col("Nit")).alias("nit")).agg(F.count(F.lit(1)).alias("lines"))


@query
def exclude_references(t):
    return exclude_values(roles.line_sales(t), "Referencia", rules.EXCLUDED_REFERENCES)


# ------------------------------------------------------------------ customers
@query
def customers_dedup(t):
    return customers.dedup_customers(roles.customer_file(t))


@query
def dedup_full_row(t):
    """Whole rows, each of them there twice."""
    return distinct_rows(t.lineitem.unionByName(t.lineitem))


# ------------------------------------------------------------------ sales
@query
def weekly_purchase_count(t):
    raw = rfm.clean_sales(roles.line_sales(t)).select(
        F.col("fecha").alias("Fecha"),
        F.col("linea_de_mercado").alias("Linea de mercado"),
        F.col("nit").alias("Razon social"),
    )
    return weekly.weekly_purchase_count(raw)


@query
def brand_from_prefix(t):
    described = t.part.select("p_partkey", roles.product_text().alias("text"), roles.product_brand().alias("brand"))
    return described.select("p_partkey", products.brand_from_prefix(F.col("text"), F.col("brand")).alias("brand"))


@query
def pack_parse(t):
    described = t.part.select("p_partkey", roles.product_text().alias("text"))
    column = F.col("text")
    return products.with_pack_and_product(described, "text", "pack", "product").select(
        "p_partkey",
        products.has_pack(column).alias("has_pack"),
        products.pack_size(column).alias("found"),
        "pack",
        products.product_name(column).alias("name"),
    )


@query
def product_normalized(t):
    described = t.part.select("p_partkey", roles.product_text().alias("text"))
    return products.with_pack_and_product(described, "text", "pack", "product").select("p_partkey", "product")


@query
def pack_multiplier(t):
    export = roles.line_export(t)
    enriched = sales.enrich_sales(export, "1990-01-01")
    units = F.col("`Cantidad inv.sell_Int`")
    return enriched.groupBy("Marca", "Cantidades", (F.col("Razon social") == rules.WHOLESALER).alias("wholesaler")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(units).alias("units")
    )


@query
def sales_enriched(t):
    return sales.enrich_sales(roles.line_export(t), CUTOFF)


@query
def sales_without_units(t):
    return sales.without_units(roles.line_export(t))


@query
def reference_key(t):
    spelled = F.concat(F.lit(" Réf-Ñ "), F.upper("p_name"), F.lit("-ÇÜ "), F.col("p_partkey").cast("string"))
    reference = F.when(F.col("p_type") != "LARGE", spelled)
    return t.part.select("p_partkey", text.reference_key(reference).alias("key"))


@query
def sales_after_cutoff(t):
    return sales.after_cutoff(roles.order_export(t), CUTOFF)


@query
def sales_since_history_max(t):
    return resume.at_or_after_history(roles.order_export(t), roles.order_history(t), "Fecha")


@query
def resume_after_marker(t):
    return sales.new_sales(roles.order_export(t), roles.order_history(t))


@query
def resume_status(t):
    return resume.resume_status(roles.order_export(t), roles.order_history(t), sales.marker_rule())


@query
def sales_refresh(t):
    return sales.refresh_sales(roles.order_export(t), roles.order_history(t), CUTOFF)


def _versioned(t: Tables) -> str:
    """The order export as a table of three versions: an adopted folder and two appends."""
    path, rule, export = scratch_path(t.spark, "versions"), sales.marker_rule(), roles.order_export(t)
    year = F.year("Fecha")
    sinks.write_parquet(export.filter(year < roles.VERSION_YEARS[0]), path)
    for first, end in zip(roles.VERSION_YEARS, (*roles.VERSION_YEARS[1:], 9999)):
        sinks.append_parquet(export.filter((year >= first) & (year < end)), path, rule.date, rule.keys)
    return path


@query
def table_versions(t):
    """What the manifest of a table that grew by appends knows."""
    found = versions.manifest_table(t.spark, _versioned(t))
    dates = {name: F.col(name).cast("timestamp_ntz") for name in ("oldest", "newest")}
    orders = {name: F.col(name).cast("bigint") for name in ("least_order", "greatest_order")}
    return found.withColumns(dates | orders).drop("batch", "n_files")


@query
def version_rows(t):
    """The rows of a table as of its second version."""
    return versions.read_versions(t.spark, _versioned(t), until=1)


@query
def resume_status_by_marks(t):
    """``resume_status`` from the history's manifest, without a scan of the history."""
    rule, path = sales.marker_rule(), scratch_path(t.spark, "history")
    sinks.write_parquet(roles.order_history(t), path)
    marks = versions.marks_of(versions.adopt(t.spark, path, rule.date, rule.keys))
    found = resume.resume_point_at(roles.order_export(t), rule, marks)
    schema = "status string, history_date timestamp_ntz, marker_date timestamp_ntz, new_rows long"
    return t.spark.createDataFrame([tuple(found[n] for n in ("status", "history_date", "marker_date", "new_rows"))], schema)


@query
def sorted_output(t):
    """Orders written in the order of customer and order number, with the place where each lies in the files."""
    keys = ["o_custkey", "o_orderkey"]
    path = sinks.write_sorted(t.orders.select(*keys, "o_totalprice"), scratch_path(t.spark, "sorted"), keys, files=16)
    rows = t.spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    return rows.join(sizes.select("file", F.coalesce(before, F.lit(0)).alias("before")), "file").select(
        *keys, "o_totalprice", (F.col("before") + F.col("at") + 1).alias("place")
    )


@query
def sorted_range(t):
    """The orders of a range of customers, from the files that hold some of them."""
    path = sinks.write_sorted(t.orders, scratch_path(t.spark, "sorted"), ["o_custkey"], files=16)
    return sinks.read_range(t.spark, path, "o_custkey", *roles.CUSTOMER_RANGE).select("o_custkey", "o_orderkey", "o_totalprice")


# ------------------------------------------------------------------ job inputs
def _sheet(t: Tables, df: DataFrame, name: str) -> str:
    """A table as delimited text, every cell as a sheet has it."""
    return sinks.write_csv(df.drop("row_ord"), scratch_path(t.spark, name) + ".csv")


@query
def load_sales_tables(t):
    """The inputs of the sales job, written as files and loaded by the catalog: rows and a sum per table."""
    columns = {"Referencia": F.lit("7"), "U.M.": F.lit("UND"), "Nit": F.lit("9")}
    export = roles.order_export(t).withColumns(columns)
    history = export.filter(F.year("Fecha") < roles.VERSION_YEARS[0])
    tables = catalog.load_sales_tables(
        t.spark, _sheet(t, history, "history"), _sheet(t, export, "new"), _sheet(t, roles.customer_file(t), "people"),
        _sheet(t, roles.cost_history(t), "costs"), _sheet(t, roles.cost_input(t), "costs_new"), _sheet(t, roles.product_family(t), "family"),
    )
    whole = lambda name: F.sum(F.col(f"`{name}`").cast("decimal(28,4)")).cast("double")
    loaded = {
        "history": (tables.history, whole("Valor bruto local")), "new": (tables.new, whole("Valor bruto local")),
        "customers": (tables.customers, F.lit(None)), "costs_history": (tables.costs_history, F.sum("Año")),
        "costs_new": (tables.costs_new, F.sum("Año")), "family": (tables.family, F.lit(None)),
        "untyped": (tables.untyped, F.lit(None)),
    }
    return _loaded(loaded)


def _loaded(tables: dict) -> DataFrame:
    rows = [
        df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("loaded"), total.cast("double").alias("total"))
        for name, (df, total) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def load_sellout_tables(t):
    """History and landed reports of the sell-out job, found in their folder, behind the gate: rows per table."""
    history = roles.sellout_history(t)
    due = sellout.due_periods(history)
    cities = roles.city_history(t).withColumns({name: F.lit(None).cast("string") for name in ("EAN", "Descripcion")})
    folder = scratch_path(t.spark, "landed")
    chain_key, _, pharmacy_key = (key for key, _ in rules.RETAILERS)
    reports = {chain_key: (rules.CHAIN, roles.chain_report(t)), pharmacy_key: (rules.PHARMACY, roles.pharmacy_report(t))}
    for key, (client, report) in reports.items():
        sinks.write_parquet(report, f"{folder}/{due[client].code}_{key}.parquet")
    files = {key: f"{due[client].code}_{key}.parquet" for key, (client, _) in reports.items()}
    found = catalog.load_sellout_tables(t.spark, _sheet(t, history, "past"), _sheet(t, cities, "cities"), folder, files)
    units = F.sum("Unidades")
    admitted = {f"report_{report.client}": (report.detail, units) for report in found.reports}
    return _loaded({"history": (found.history, units), "cities": (found.cities, units), **admitted})


@query
def load_segment_tables(t):
    """The inputs of the segments job as delimited files: what the job cleans and types of them."""
    sold = readers.read_table(t.spark, _sheet(t, roles.line_sales(t), "sales"))
    people = readers.read_table(t.spark, _sheet(t, roles.customer_register(t), "people"))
    tagged = rfm.tagged_sales(sold)
    revenue = F.sum(rfm.cents(F.col("valor_bruto_local")))
    return _loaded({
        "sales": (tagged.drop(rfm.UNREAD), revenue), "unread": (rfm.unread_sales(tagged), F.lit(None)),
        "register": (rfm.clean_customers(people), F.lit(None)),
    })


@query
def required_columns(t):
    """Per source and needed column: whether the source has it, and how many rows it fills there."""
    sources = {"orders": roles.order_export(t), "lines": roles.line_sales(t), "costs": roles.cost_history(t)}
    found = []
    for name, df in sources.items():
        for column in ("Fecha", "Referencia", "Valor bruto local"):
            try:
                schemas.require_columns(df, [column])
                filled = F.count(F.col(f"`{column}`"))
            except schemas.MissingColumns:
                filled = F.lit(None).cast("bigint")
            found.append(df.agg(F.lit(name).alias("source"), F.lit(column).alias("column"), filled.alias("filled")))
    return reduce(DataFrame.unionByName, found)


# ------------------------------------------------------------------ scans and cells
@query
def scan_typed(t):
    """A typed table with the place of each row in its file."""
    scanned = readers.read_table(t.spark, f"{t.folder}/orders.parquet")
    return scanned.withColumn("place", F.col("row_ord.place")).drop("row_ord")


def _raw_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("order"),
        F.concat(F.lit(" "), F.col("l_quantity").cast("bigint").cast("string")).alias("units"),
        F.replace(roles.money_text("l_extendedprice"), F.lit("."), F.lit(",")).alias("amount"),
        F.when(F.col("l_returnflag") != "A", roles.day_text("l_shipdate")).otherwise("?").alias("day"),
    )


_LINES = {"order": "bigint", "units": "bigint", "amount": "decimal(18,2)", "day": "timestamp_ntz"}


@query
def scan_string_then_type(t):
    typed = schemas.apply_types(_raw_lines(t), _LINES)
    return typed.withColumn("amount", F.col("amount").cast("double"))


@query
def untyped_rows(t):
    """The rejects of the typing step."""
    return schemas.untyped_rows(_raw_lines(t), _LINES)


@query
def scan_text_file(t):
    """The lines written as delimited text and read back by their types."""
    path = sinks.write_csv(_raw_lines(t), scratch_path(t.spark, "lines") + ".csv")
    typed = readers.read_table(t.spark, path, _LINES).drop("row_ord")
    return typed.withColumn("amount", F.col("amount").cast("double"))


@query
def parse_dates_strict(t):
    """Every text must fit one of the formats."""
    spelled = F.when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(
        roles.day_text("l_shipdate")
    )
    day = calendar.parse_timestamp_strict(spelled, ("yyyy-MM-dd", "dd/MM/yyyy"))
    return t.lineitem.select("l_orderkey", "l_linenumber", day.alias("day"))


@query
def parse_dates(t):
    return roles.order_cells(t).select("o_orderkey", calendar.parse_timestamp(F.col("fecha")).alias("day"))


@query
def parse_decimal_comma(t):
    value = text.decimal_comma(F.col("valor")).cast("double")
    return roles.order_cells(t).select("o_orderkey", value.alias("value"))


@query
def canonical_key(t):
    return roles.order_cells(t).select("o_orderkey", text.canonical_key(F.col("cell")).alias("key"))


@query
def clean_table(t):
    sheet = roles.order_cells(t).select(
        "o_orderkey",
        F.col("cell").alias(" Celda   libre "),
        F.when(F.col("fecha") != "pendiente", F.col("fecha")).alias("Día*"),
        F.when(F.col("valor") != "n/d", F.col("valor")).alias("Valor  (bruto)"),
        F.col("codigo").alias(" Código "),
        F.lit(None).cast("string").alias("Vacía"),
    )
    return cells.clean_table(sheet, keep=("o_orderkey",))


@query
def normalize_headers(t):
    return columns.normalize_headers(roles.spanish_suppliers(t))


@query
def drop_all_null_columns(t):
    empty = t.customer.withColumn("nothing", F.lit(None).cast("string"))
    return columns.drop_all_null_columns(empty)


@query
def drop_all_null_rows(t):
    rich = F.col("c_acctbal") > 0
    cells = [F.when(rich, F.col(name)).alias(name) for name in t.customer.columns]
    return columns.drop_all_null_rows(t.customer.select(*cells))


@query
def nonblank_stores(t):
    return columns.select_names(sellout.chain_rows(roles.chain_report(t)), ["EAN", "Nomb. Dependencia", "Unidades"])


# ------------------------------------------------------------------ costs
@query
def cost_with_family(t):
    return costs.costs_with_family(roles.cost_history(t), roles.product_family(t))


@query
def cost_next_period(t):
    return costs.new_costs(roles.cost_input(t), roles.cost_history(t), COST_YEAR)


@query
def next_period_by_year(t):
    return costs.next_cost_period(roles.cost_history(t), COST_YEAR)


@query
def cost_consolidated(t):
    return costs.consolidate_costs(roles.cost_history(t), roles.cost_input(t), roles.product_family(t), COST_YEAR)


# ------------------------------------------------------------------ sell-out
def _chain(t: Tables) -> sellout.SellOut:
    due = sellout.due_periods(roles.sellout_history(t), (rules.CHAIN,))
    return sellout.chain(roles.chain_report(t), due[rules.CHAIN])


def _wholesale(t: Tables) -> sellout.SellOut:
    due = sellout.due_periods(roles.sellout_history(t), (rules.WHOLESALER,))
    return sellout.wholesale(roles.wholesale_matrix(t), due[rules.WHOLESALER])


def _pharmacy(t: Tables) -> sellout.SellOut:
    due = sellout.due_periods(roles.sellout_history(t), (rules.PHARMACY,))
    return sellout.pharmacy(roles.pharmacy_report(t), due[rules.PHARMACY])


def _reports(t: Tables) -> list[sellout.SellOut]:
    due = sellout.due_periods(roles.sellout_history(t))
    return [
        sellout.chain(roles.chain_report(t), due[rules.CHAIN]),
        sellout.wholesale(roles.wholesale_matrix(t), due[rules.WHOLESALER]),
        sellout.pharmacy(roles.pharmacy_report(t), due[rules.PHARMACY]),
    ]


@query
def unpivot_month_matrix(t):
    return reshape.unpivot_months(roles.wholesale_matrix(t), rules.MATRIX_IDS)


@query
def month_matrix_files(t):
    """The matrix written as files with two header lines, read and unpivoted."""
    path = scratch_path(t.spark, "matrix")
    lines = roles.matrix_lines(t).repartition("file").sortWithinPartitions("file", "place")
    lines.select("file", "value").write.partitionBy("file").text(path)
    rows, _ = readers.read_month_matrix(t.spark, path)
    return reshape.unpivot_months(rows, rules.MATRIX_IDS).withColumn("Unidades", F.col("Unidades").cast("bigint"))


@query
def other_months(t):
    """Detail rows of the store chain that are not of the month that is due."""
    return sellout.other_months(_chain(t).detail)


@query
def unknown_months(t):
    """Rows of the history whose month is no code."""
    history = roles.sellout_history(t)
    month = F.when(F.col("NumMes") == 6, "JUNIO").when(F.col("NumMes") != 7, F.col("Mes"))
    return periods.unknown_months(history.withColumn("Mes", month))


@query
def store_city_chain(t):
    named = roles.suppliers(t).select("s_suppkey", roles.chain_store_text().alias("name"))
    return named.select("s_suppkey", stores.store_city_chain(F.col("name")).alias("p")).select("s_suppkey", "p.*")


@query
def store_city_wholesale(t):
    named = roles.suppliers(t).select("s_suppkey", roles.wholesale_store_text().alias("name"))
    return named.select("s_suppkey", stores.store_city_wholesale(F.col("name")).alias("p")).select("s_suppkey", "p.*")


@query
def sellout_city_chain(t):
    return _chain(t).detail


@query
def sellout_city_wholesale(t):
    return _wholesale(t).detail


@query
def sellout_city_pharmacy(t):
    return _pharmacy(t).detail


@query
def sellout_summary(t):
    return columns.union_present([report.summary for report in _reports(t)])


@query
def sellout_summary_append(t):
    return sellout.append_summaries(roles.sellout_history(t), _reports(t))


@query
def sellout_city_append(t):
    return sellout.append_details(roles.city_history(t), _reports(t))


@query
def union_optional_sources(t):
    nations = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    parties = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    sellers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return columns.union_present([nations, None, parties, sellers])


@query
def client_last_period(t):
    return periods.last_period(roles.sellout_history(t))


@query
def month_codes(t):
    code = F.element_at(F.array(*map(F.lit, rules.MONTH_CODES)), F.month("o_orderdate"))
    coded = t.orders.select(F.when(F.col("o_orderstatus") == "P", F.lit("???")).otherwise(code).alias("code"))
    counted = coded.groupBy("code").agg(F.count(F.lit(1)).alias("orders"))
    column = F.col("code")
    return counted.select(
        "code",
        calendar.month_number_of_code(column).alias("number"),
        calendar.month_full_name(column).alias("name"),
        "orders",
    )


@query
def file_name_gate(t):
    return periods.file_name_gate(roles.landed_files(t))


@query
def period_gate(t):
    return periods.period_gate(roles.landed_files(t), roles.sellout_history(t))
