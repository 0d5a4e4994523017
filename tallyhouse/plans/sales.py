"""Sales: enrichment of new rows and the refresh of the history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import calendar, products
from tallyhouse.functions.text import canonical_key, decimal_comma
from tallyhouse.operators.columns import column, insert_column, select_names, union_present
from tallyhouse.operators.lookup import left_lookup
from tallyhouse.operators.resume import ResumeRule, rows_after_marker
from tallyhouse.schemas import ROW_ORD, require_columns, whole_number
from tallyhouse.session import write_through

# the columns of an export that are kept; later ones go (``dropped_columns`` names them)
KEPT_COLUMNS = 12
PACK, PRODUCT, SOLD = "Cantidades", "Producto", "Cantidad inv.sell_Int"
TYPED_KEYS = ("Fecha", "Cantidad inv.", "Valor bruto local")
DESCRIPTION = "Desc.item"
#: Descriptions that are sent to all tasks; a larger catalogue meets the sales in a shuffle.
BROADCAST_TEXTS = 100_000


def as_moment(df: DataFrame, name: str, formats=calendar.ISO) -> Column:
    """A date column as a timestamp without zone, parsed if it is still text."""
    value = column(df, name)
    if dict(df.dtypes)[name] == "string":
        return calendar.parse_timestamp(value, formats)
    return value.cast("timestamp_ntz")


def after_cutoff(sales: DataFrame, cutoff: str = rules.SALES_CUTOFF) -> DataFrame:
    """Rows strictly after the cutoff; rows without a date go. A typed date column takes the filter to the scan."""
    moment = as_moment(sales, "Fecha")
    return sales.filter(moment > calendar.moment(cutoff))


def _description(df: DataFrame) -> str:
    return DESCRIPTION if DESCRIPTION in df.columns else "Desc. item"


def whole_units(sales: DataFrame, name: str = "Cantidad inv.") -> Column:
    """Units as the history reads them, so that marker, rejects and typing agree."""
    return whole_number(column(sales, name))


def without_units(sales: DataFrame) -> DataFrame:
    """Rows whose units are missing or not whole: the rejects of the enrichment."""
    return sales.filter(whole_units(sales).isNull())


def describe(sales: DataFrame, product_rules: rules.ProductRules) -> DataFrame:
    """Add pack and product.

    A catalogue has far fewer descriptions than there are sales, and the word rules are some thirty searches per text: in
    a table they run once per distinct description, and are joined back. The described texts are written first: joined
    as they come, the sales would be shuffled before their number is known. Up to ``BROADCAST_TEXTS`` of them go to all
    tasks, where the sales lie; AQE splits a hot description of a catalogue that is larger. A stream, whose files are
    not all there, runs the rules on each row.
    """
    if not sales.isStreaming:
        keyed = sales.withColumn("_text", column(sales, DESCRIPTION))
        texts = keyed.select("_text").filter("_text is not null").distinct()
        known = write_through(products.with_pack_and_product(texts, "_text", PACK, PRODUCT, product_rules), "descriptions")
        if known.count() <= BROADCAST_TEXTS:
            known = F.broadcast(known)
        joined = left_lookup(keyed, known, "_text").drop("_text")
        return joined.withColumn(PACK, F.coalesce(PACK, F.lit(rules.MISSING_PACK)))
    return products.with_pack_and_product(sales, DESCRIPTION, PACK, PRODUCT, product_rules)


def dropped_columns(sales: DataFrame, keep: int = KEPT_COLUMNS) -> list[str]:
    """The columns of an export that the enrichment leaves out."""
    body = [name for name in sales.columns if name != ROW_ORD]
    return body[keep - 1 :]


def enrich_sales(
    sales: DataFrame,
    cutoff: str = rules.SALES_CUTOFF,
    product_rules: rules.ProductRules = rules.ProductRules(),
    keep: int = KEPT_COLUMNS,
    formats=calendar.ISO,
) -> DataFrame:
    """Brand, pack size, normalised product and units in pieces for the rows after the cutoff.

    The first ``keep`` columns are kept as they are, counting an empty identification type in the fourth place.
    Rows without whole units are left out; see ``without_units``. ``formats`` reads dates that are still text.
    """
    require_columns(sales, ["Fecha", _description(sales), "Cantidad inv.", "Razon social", "Marca"])
    recent = after_cutoff(sales.withColumn("Fecha", as_moment(sales, "Fecha", formats)), cutoff)
    recent = recent.filter(whole_units(recent).isNotNull()).withColumnsRenamed({"Desc. item": DESCRIPTION})
    body = recent.drop(ROW_ORD)
    kept = insert_column(body, 3, "Tipo de identificacion", F.lit(None).cast("string"), keep=keep).columns
    order = [ROW_ORD] if ROW_ORD in recent.columns else []

    branded = recent.withColumns(
        {
            "Marca": products.brand_from_prefix(column(recent, DESCRIPTION), column(recent, "Marca"), product_rules.brands),
            "Tipo de identificacion": F.lit(None).cast("string"),
        }
    )
    described = describe(branded, product_rules)
    units = products.sold_units(
        whole_units(described), F.col("Razon social"), F.col("Marca"), F.col(PACK), product_rules.pack_rule
    )
    result = described.withColumn(SOLD, units)
    return select_names(result, kept + [PACK, PRODUCT, SOLD] + order)


def marker_rule(keys=rules.MARKER_KEYS, prefixes=rules.BRAND_PREFIXES) -> ResumeRule:
    """Compare text cells by their cleaned form, units, amounts and dates by value, null equal to null.

    The history holds filled brands, so the brand of the new rows is filled before it is compared.
    """

    def build(df: DataFrame) -> dict[str, Column]:
        types = dict(df.dtypes)
        parts = {}
        for name in sorted(keys, key=lambda name: name not in TYPED_KEYS):
            value = column(df, name)
            if name == "Marca":
                value = products.brand_from_prefix(column(df, _description(df)), value, prefixes)
            if name == "Fecha":
                value = as_moment(df, name)
            elif name == "Cantidad inv.":
                value = whole_units(df, name)
            elif name == "Valor bruto local":
                value = decimal_comma(value)
            elif types[name] == "string":
                value = canonical_key(value)
            parts[name] = value
        return parts

    return ResumeRule(build, "Fecha")


def new_sales(new: DataFrame, history: DataFrame, rule: ResumeRule | None = None) -> DataFrame:
    """The rows of the export after the last row of the history. None if that row is not found."""
    require_columns(new, rules.MARKER_KEYS + (ROW_ORD,))
    require_columns(history, rules.MARKER_KEYS + (ROW_ORD,))
    return rows_after_marker(new, history, rule or marker_rule()).withColumnsRenamed({"EAN 13": "EAN"})


def after_point(new: DataFrame, point: dict) -> DataFrame:
    """``new_sales`` from a place that ``resume_point`` has found."""
    place, order = point["place"], new.schema[ROW_ORD].dataType
    known = F.struct(*[F.lit(place[f.name]).cast(f.dataType).alias(f.name) for f in order]) if isinstance(place, dict) else F.lit(place)
    later = new.filter((F.col("Fecha") >= F.lit(point["newest"])) & (F.col(ROW_ORD) > known))
    return later.withColumnsRenamed({"EAN 13": "EAN"})


def refresh_sales(new: DataFrame, history: DataFrame, cutoff: str = rules.SALES_CUTOFF, **options) -> DataFrame:
    """The history with the enriched new rows appended, by column name."""
    return union_present([history, enrich_sales(new_sales(new, history), cutoff, **options)])
