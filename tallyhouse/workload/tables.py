"""The given tables in the roles of the business inputs.

The tables have no nulls, no orphan keys and clean text, so each role makes some from ordinary attributes: an order
status, a priority, a product type. Every role reads its whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import rules

SEGMENT_CHANNELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
AS_OF = "2002-01-01"
HISTORY_END = "2000-07-01"
CUTOFF = "1998-01-01"
COST_YEAR = 2001
#: First years of the second and third version of the order export; a range of customers.
VERSION_YEARS = (1997, 2000)
CUSTOMER_RANGE = (100, 400)
COST_HISTORY_END = "2001-07-01"
ORDINAL_STRIDE = 10_000_000_000
#: Suppliers whose lines of the month matrix share a file, but for chance, and the fewest files.
SUPPLIERS_OF_FILE = 100
LEAST_FILES = 8


class Tables:
    """Lazy readers of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def cases(pairs, otherwise: Column) -> Column:
    return reduce(lambda rest, pair: F.when(pair[0], pair[1]).otherwise(rest), reversed(pairs), otherwise)


def text(column: str) -> Column:
    return F.col(column).cast("string")


def money_text(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


def day_text(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


# ------------------------------------------------------------------ segmentation
def order_sales(t: Tables) -> DataFrame:
    """Orders as sales: market segment as channel, customer name, date, price."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_mktsegment").alias("linea_de_mercado"),
        F.col("c_name").alias("razon_social"),
        F.col("o_orderdate").alias("fecha"),
        F.col("o_totalprice").alias("valor_bruto_local"),
    )


def line_sales(t: Tables) -> DataFrame:
    """Order lines as raw text sales, with missing tax ids and references, bad amounts and bad dates."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    day = day_text("o_orderdate")
    return joined.select(
        F.when(
            ~((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("l_returnflag") == "N")),
            F.concat(text("o_custkey"), F.lit("-"), text("l_linenumber")),
        ).alias("Nit"),
        F.when(F.col("l_discount") < 0.1, text("l_partkey")).alias("Referencia"),
        F.col("c_mktsegment").alias("Linea de mercado"),
        cases(
            [
                ((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("sin fecha")),
                (F.col("o_orderstatus") == "P", F.concat(F.lit(" "), day, F.lit(" 00:00:00"))),
            ],
            day,
        ).alias("Fecha"),
        F.when(F.col("l_tax") == 0, "n/d")
        .otherwise(F.replace(money_text("l_extendedprice"), F.lit("."), F.lit(",")))
        .alias("Valor bruto local"),
        F.col("l_quantity").cast("bigint").alias("cantidad"),
    )


def customer_register(t: Tables) -> DataFrame:
    """The raw register: customers with debts are not in it, rich ones are in it twice, after a row without a name."""
    known = t.customer.filter(F.col("c_acctbal") >= 0)
    rich = known.filter(F.col("c_acctbal") > 5000)
    unnamed = rich.select(
        F.lit("CC").alias("Tipo"),
        F.concat(text("c_custkey"), F.lit("-9")).alias("Nit"),
        F.when(F.col("c_mktsegment") == "BUILDING", " ").alias("Razón social"),
        (F.col("c_custkey") * 3).alias("row_ord"),
    )
    first = known.select(
        F.lit("NIT").alias("Tipo"),
        F.concat(text("c_custkey"), F.lit("-0")).alias("Nit"),
        F.col("c_name").alias("Razón social"),
        (F.col("c_custkey") * 3 + 1).alias("row_ord"),
    )
    second = rich.select(
        F.lit("CC").alias("Tipo"),
        F.concat(text("c_custkey"), F.lit("-1")).alias("Nit"),
        F.concat(F.col("c_name"), F.lit(" (2)")).alias("Razón social"),
        (F.col("c_custkey") * 3 + 2).alias("row_ord"),
    )
    return first.unionByName(second).unionByName(unnamed)


def customer_file(t: Tables) -> DataFrame:
    """Customers with padded and missing tax ids, and an altered later copy of each."""
    nit = F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit(" "), text("c_nationkey"), F.lit("-"),
                                                              text("c_custkey"), F.lit("  ")))
    first = t.customer.select(
        nit.alias("nit"), F.col("c_name").alias("razon_social"), F.col("c_custkey").alias("row_ord")
    )
    copy = t.customer.select(
        F.trim(nit).alias("nit"),
        F.concat(F.col("c_name"), F.lit(" SAS")).alias("razon_social"),
        (F.col("c_custkey") + ORDINAL_STRIDE).alias("row_ord"),
    )
    return copy.unionByName(first)


# ------------------------------------------------------------------ products and sales
def product_text() -> Column:
    """A description per product type, with brand prefixes, synonyms and packs; some large products have none."""
    name, size, kind = F.upper("p_name"), text("p_size"), F.col("p_type")
    return cases(
        [
            (kind == "STANDARD", F.concat(F.lit("NAT JABO "), name, F.lit(" X "), size, F.lit("UND"))),
            (kind == "PROMO", F.concat(F.lit("JDE CREM "), name, F.lit(" X"), size, F.lit("ML"))),
            (kind == "ECONOMY", F.concat(F.lit(" nat gel duch "), F.lower(name), F.lit(" x "), size, F.lit("gr "))),
            (kind == "SMALL", F.concat(F.lit("CED HUME LIQ "), name)),
            (kind == "MEDIUM", F.concat(F.lit("NAT  EFERV ACTI "), name, F.lit(" X "),
                                        F.when(F.col("p_size") < 25, "48UND").otherwise("6UND x 2"))),
            ((kind == "LARGE") & (F.col("p_size") <= 40), F.concat(F.lit("PER JAB VEG SPA "), name, F.lit(" BOX"), size)),
        ],
        F.lit(None).cast("string"),
    )


def product_brand() -> Column:
    return F.when(F.col("p_type").isin("PROMO", "LARGE") & (F.col("p_size") > 20), F.col("p_brand"))


def line_export(t: Tables) -> DataFrame:
    """Order lines as the sales export, eleven columns.

    Orders meet their customers before the lines, which move once for the orders and once for the parts.
    """
    buyer = F.when(F.col("c_mktsegment") == "HOUSEHOLD", rules.WHOLESALER).otherwise(F.col("c_name"))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "c_mktsegment", buyer.alias("buyer")
    )
    parts = t.part.select("p_partkey", product_brand().alias("brand"), product_text().alias("description"))
    joined = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("Fecha"),
        F.col("brand").alias("Marca"),
        F.col("c_mktsegment").alias("Linea de mercado"),
        F.col("buyer").alias("Razon social"),
        text("l_partkey").alias("Referencia"),
        F.col("description").alias("Desc. item"),
        F.concat(F.lit("77"), text("l_partkey")).alias("EAN 13"),
        F.lit("UND").alias("U.M."),
        text("l_linenumber").alias("Nit"),
        F.when(F.col("l_tax") == 0.08, F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".5")))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        .alias("Cantidad inv."),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Valor bruto local"),
    )


def order_ordinal() -> Column:
    """File order: by date, then by order number."""
    return F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * ORDINAL_STRIDE + F.col("o_orderkey")


def order_export(t: Tables) -> DataFrame:
    """Orders as a sales export in file order; the brand of urgent orders is left to the prefix rule."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("Fecha"),
        F.when(F.col("o_orderpriority") != "1-URGENT", rules.BRAND_PREFIXES[0][1]).alias("Marca"),
        F.col("c_mktsegment").alias("Linea de mercado"),
        F.col("c_name").alias("Razon social"),
        F.concat(F.lit("NAT JABO "), F.col("o_orderpriority"), F.lit(" X 6UND")).alias("Desc. item"),
        text("o_orderkey").alias("EAN 13"),
        F.dayofmonth("o_orderdate").cast("bigint").alias("Cantidad inv."),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Valor bruto local"),
        order_ordinal().alias("row_ord"),
    )


def order_history(t: Tables) -> DataFrame:
    """The part of the export that was there before, with the brand filled."""
    export = order_export(t)
    return export.filter(F.col("Fecha") < F.lit(HISTORY_END).cast("timestamp_ntz")).withColumnsRenamed(
        {"EAN 13": "EAN", "Desc. item": "Desc.item"}
    ).withColumn("Marca", F.lit(rules.BRAND_PREFIXES[0][1]))


# ------------------------------------------------------------------ costs
def monthly_costs(lines: DataFrame) -> DataFrame:
    """The average price per part and month of shipping, in ten-thousandths cut off, as a number."""
    cents = (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("bigint")
    grouped = (
        lines.groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("month"))
        .agg(F.sum(cents).alias("cents"), F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
    )
    month = F.element_at(F.array(*map(F.lit, rules.MONTH_NAMES)), F.month("month"))
    return grouped.select(
        text("l_partkey").alias("Referencia"),
        F.concat(F.lit("item "), text("l_partkey")).alias("Desc.item"),
        F.lit("001").alias("Instalación"),
        F.lit("UND").alias("U.M."),
        (F.expr("(cents * 100) div units") / F.lit(10000.0)).alias("Costo prom."),
        F.initcap(month).alias("Mes"),
        F.year("month").alias("Año"),
    )


def cost_history(t: Tables) -> DataFrame:
    return monthly_costs(t.lineitem.filter(F.col("l_shipdate") < F.lit(COST_HISTORY_END).cast("timestamp_ntz")))


def cost_input(t: Tables) -> DataFrame:
    """The whole cost report, with its own header names and a brand."""
    return (
        monthly_costs(t.lineitem)
        .withColumnsRenamed({"Costo prom.": "Costo prom. uni.", "Desc.item": "Desc. item"})
        .withColumn("Marca", F.lit(rules.BRAND_PREFIXES[1][1]))
    )


def product_family(t: Tables) -> DataFrame:
    """Parts as families; economy parts are missing and promo parts are listed twice."""
    family = t.part.filter(F.col("p_type") != "ECONOMY").select(
        text("p_partkey").alias("Referencia"),
        F.col("p_brand").alias("Marca"),
        F.when(F.col("p_size") > 10, "Si").alias("Incluir referencia(Si/No)"),
    )
    again = t.part.filter(F.col("p_type") == "PROMO").select(
        text("p_partkey").alias("Referencia"),
        F.lit(None).cast("string").alias("Marca"),
        F.lit("No").alias("Incluir referencia(Si/No)"),
    )
    return family.unionByName(again)


# ------------------------------------------------------------------ sell-out
def chain_store_text() -> Column:
    known = rules.CHAIN_STORES[0][0]
    return cases(
        [
            (F.col("n_nationkey") < 10, F.concat(F.lit(" "), F.col("s_name"), F.lit(" - "), F.col("n_name"))),
            (F.col("n_nationkey") < 15, F.concat(F.col("s_name"), F.lit("-"), F.col("n_name"), F.lit("- LOCAL"))),
            (F.col("n_nationkey") < 18, F.lit(known)),
            (F.col("n_nationkey") < 20, F.lit("  ")),
            (F.col("n_nationkey") < 22, F.lit(None).cast("string")),
        ],
        F.col("s_name"),
    )


def wholesale_store_text() -> Column:
    code = F.concat(text("n_nationkey"), F.lit("-"))
    name, nation = F.col("s_name"), F.col("n_name")
    return cases(
        [
            (F.col("n_nationkey") < 8, F.concat(code, name, F.lit(" - "), nation)),
            (F.col("n_nationkey") < 14, F.concat(code, F.lit("Villa - "), name, F.lit(" - "), nation)),
            (F.col("n_nationkey") < 16, F.concat(code, F.lit(rules.WHOLESALE_STORES[0][0].title()))),
            (F.col("n_nationkey") < 18, F.concat(code, F.lit(rules.WHOLESALE_STORES[2][0].title()))),
            (F.col("n_nationkey") < 20, F.lit(None).cast("string")),
            (F.col("n_nationkey") < 21, F.lit(" ")),
        ],
        F.concat(code, name),
    )


def suppliers(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))


def _lines_with_store(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        suppliers(t), F.col("l_suppkey") == F.col("s_suppkey")
    )


def chain_report(t: Tables) -> DataFrame:
    return _lines_with_store(t).select(
        text("l_partkey").alias("EAN"),
        F.col("l_shipdate").alias("Fecha"),
        chain_store_text().alias("Nomb. Dependencia"),
        product_text().alias("Descripción"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("bigint")).alias("Unidades"),
    )


def pharmacy_report(t: Tables) -> DataFrame:
    return _lines_with_store(t).select(
        text("l_partkey").alias("UPC"),
        F.col("s_name").alias("NOMBRE_TIENDA"),
        F.when(F.col("n_nationkey") != 7, F.col("n_name")).alias("CIUDAD"),
        product_text().alias("DESCRIPCION_ITEM"),
        # sold by halves
        (F.col("l_quantity") * 0.5).cast("decimal(18,1)").alias("UNIDADES_VENDIDAS"),
        F.col("p_brand").alias("SUP_NAME"),
    )


def wholesale_matrix(t: Tables) -> DataFrame:
    """Units by store and product type, a column per month of shipping, next to a measure that is not wanted.

    Returns count negative, so that cells can be negative or zero.
    """
    units = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint")
    store, article, description, barcode = rules.MATRIX_IDS
    months = []
    for number, name in enumerate(rules.MONTH_NAMES, 1):
        of_month = F.when(F.month("l_shipdate") == number, units)
        months.append(F.sum(of_month).alias(f"{name.capitalize()}|{rules.MATRIX_MEASURE}"))
        months.append(F.count(of_month).alias(f"{name.capitalize()}|Inv."))
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    matrix = lines.groupBy("l_suppkey", "p_type", "p_size").agg(*months)
    named = matrix.join(suppliers(t), F.col("l_suppkey") == F.col("s_suppkey"))
    measures = [named[f"`{name}`"] for name in matrix.columns if "|" in name]
    return named.select(
        wholesale_store_text().alias(store),
        text("p_size").alias(article),
        F.concat(F.col("p_type"), F.lit(" "), text("p_size")).alias(description),
        F.concat(text("l_suppkey"), F.lit("/"), F.col("p_type"), text("p_size")).alias(barcode),
        *measures,
    )


def matrix_lines(t: Tables) -> DataFrame:
    """The matrix as the lines of delimited files, some hundred suppliers in each: (file, place, value).

    Each has the lines before the header, the two header lines, then its rows; a comma is the decimal sign of half of
    the cells, which are quoted for it. A file per supplier would take longer to make and to open than to read.
    """
    files = max(LEAST_FILES, -(-t.supplier.count() // SUPPLIERS_OF_FILE))
    file = F.pmod(F.hash("l_suppkey"), F.lit(files)).alias("file")
    matrix = wholesale_matrix(t)
    barcode = F.col(f"`{rules.MATRIX_IDS[3]}`")
    cells = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in rules.MATRIX_IDS]
    upper, lower = list(rules.MATRIX_IDS), [""] * len(rules.MATRIX_IDS)
    for i, name in enumerate(name for name in matrix.columns if "|" in name):
        month, what = name.split("|")
        upper.append("" if i % 2 else month)
        lower.append(what)
        value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        cells.append(F.when(value != "", F.concat(F.lit('"'), value, F.lit(',00"'))).otherwise("") if i % 4 else value)
    body = matrix.select(
        F.split(barcode, "/")[0].cast("bigint").alias("l_suppkey"),
        F.lit(rules.MATRIX_PREAMBLE_LINES + rules.MATRIX_HEADER_LINES).alias("place"),
        F.concat_ws(",", *cells).alias("value"),
    )
    head = [f"Reporte, linea {i}" for i in range(rules.MATRIX_PREAMBLE_LINES)] + [",".join(upper), ",".join(lower)]
    named = t.lineitem.select(file).distinct().select("file", F.posexplode(F.array(*map(F.lit, head))))
    return named.withColumnsRenamed({"pos": "place", "col": "value"}).unionByName(body.select(file, "place", "value"))


def retailer_of_status() -> Column:
    return cases(
        [(F.col("o_orderstatus") == "F", F.lit(rules.CHAIN)), (F.col("o_orderstatus") == "O", F.lit(rules.WHOLESALER))],
        F.lit(rules.PHARMACY),
    )


def sellout_history(t: Tables) -> DataFrame:
    """Orders per status and month as the sell-out history of the three retailers."""
    number = F.month("o_orderdate")
    return (
        t.orders.groupBy(retailer_of_status().alias("cliente"), F.year("o_orderdate").alias("año"), number.alias("NumMes"))
        .agg(F.count(F.lit(1)).alias("Unidades"))
        .select(
            F.element_at(F.array(*map(F.lit, rules.MONTH_CODES)), F.col("NumMes")).alias("Mes"),
            "año",
            "cliente",
            "Unidades",
            "NumMes",
        )
    )


def city_history(t: Tables) -> DataFrame:
    """Units by nation as the earlier city detail, without a product."""
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("Unidades"))
        .select(
            F.lit(rules.PHARMACY).alias("cliente"),
            F.lit("ENE").alias("Mes"),
            F.lit(1995).alias("año"),
            F.col("c_mktsegment").alias("Tienda"),
            F.col("n_name").alias("Ciudad"),
            "Unidades",
            F.lit(1).alias("NumMes"),
        )
    )


def landed_files(t: Tables) -> DataFrame:
    """A file per retailer, month and priority of the orders; the priority decides how its name is wrong."""
    distinct = t.orders.select("o_orderstatus", F.month("o_orderdate").alias("m"), "o_orderpriority").distinct()
    keys = [key for key, _ in rules.RETAILERS]
    key = cases(
        [(F.col("o_orderstatus") == "F", F.lit(keys[0])), (F.col("o_orderstatus") == "O", F.lit(keys[1]))],
        F.lit(keys[2]),
    )
    code = F.element_at(F.array(*map(F.lit, rules.MONTH_CODES)), F.col("m"))
    priority, end = F.col("o_orderpriority"), F.lit(rules.LANDED_SUFFIX)
    return distinct.select(
        key.alias("client_key"),
        cases(
            [
                (priority == "1-URGENT", F.concat(code, F.lit("_"), key, end)),
                (priority == "2-HIGH", F.concat(F.lower(code), F.lit("_"), F.lower(key), end)),
                (priority == "3-MEDIUM", F.concat(code, key, end)),
                (priority == "4-NOT SPECIFIED", F.concat(F.lit("XXX_"), key, end)),
            ],
            F.concat(code, F.lit("_OTHER_"), key, end),
        ).alias("file_name"),
    )


# ------------------------------------------------------------------ text cells
def order_cells(t: Tables) -> DataFrame:
    """Order attributes as the text cells of a sheet, in the spellings that people leave there."""
    priority, price = F.col("o_orderpriority"), money_text("o_totalprice")
    cell = cases(
        [
            (priority == "1-URGENT", F.concat(F.lit("  "), F.replace(price, F.lit("."), F.lit(",")), F.lit(" "))),
            (priority == "2-HIGH", F.concat(text("o_custkey"), F.lit("00000"))),
            (priority == "3-MEDIUM", F.lit(" NaN ")),
            (priority == "4-NOT SPECIFIED", F.concat(F.lit("LINEA   "), F.col("o_orderstatus"), F.lit("  DOS"))),
        ],
        price,
    )
    day = day_text("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        cell.alias("cell"),
        cases(
            [
                (F.col("o_orderstatus") == "P", F.concat(F.lit(" "), day, F.lit(" 12:30:00 "))),
                ((F.col("o_orderstatus") == "O") & (priority == "5-LOW"), F.lit("pendiente")),
            ],
            day,
        ).alias("fecha"),
        F.when(priority == "3-MEDIUM", "n/d")
        .otherwise(F.replace(price, F.lit("."), F.lit(",")))
        .alias("valor"),
        # codes that a cast would take for numbers
        F.concat(text("o_custkey"), F.when(F.col("o_orderstatus") == "F", "F").otherwise("D")).alias("codigo"),
    )


def spanish_suppliers(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("Código Prov."),
        F.col("s_name").alias("Razón Social"),
        F.col("s_nationkey").alias("País"),
        F.col("s_acctbal").alias("Saldo Bruto"),
    )
