"""Customer segments per channel by recency, frequency and monetary value.

Money is summed in whole cents: exact, independent of the order, and a long instead of a wide decimal.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions import calendar
from tallyhouse.functions.text import decimal_comma, is_filled, tax_id_root
from tallyhouse.operators.columns import complete, normalize_headers, rename_by_position
from tallyhouse.operators.dedup import distinct_rows, first_by_key
from tallyhouse.operators.lookup import exclude_values, left_lookup
from tallyhouse.operators.ranking import order_statistics, rank_in_group, rank_sorted, sort_once
from tallyhouse.plans.sales import as_moment
from tallyhouse.schemas import ROW_ORD, require_columns, untyped_cell
from tallyhouse.session import write_through

PARTS = 5
FREQUENCY_ORDER = ["purchase_dates", "customer_id"]
CENTS_PER_THOUSAND = 100_000
CUSTOMER_COLUMNS = ["tipo_identificacion", "nit", "razon_social"]


def cents(value: Column) -> Column:
    return (value.cast("decimal(18,2)") * 100).cast("bigint")


#: In tagged sales: the texts of a row with a cell that cannot be read, else null.
UNREAD = "_unread"


def _plain_sales(sales: DataFrame, formats) -> tuple[DataFrame, dict[str, Column]]:
    """The sales under plain headers, and the values that the cleaning gives its columns."""
    plain = require_columns(normalize_headers(sales), ["nit", "referencia", "linea_de_mercado", "fecha"])
    amount = "valor_bruto_local"
    values = {"nit": tax_id_root(F.col("nit")), "fecha": as_moment(plain, "fecha", formats)}
    if amount in plain.columns and dict(plain.dtypes)[amount] == "string":
        values[amount] = decimal_comma(F.col(amount))
    return plain, values


def _unreadable(plain: DataFrame, formats) -> Column:
    read = {"fecha": "timestamp_ntz", "valor_bruto_local": "decimal(18,2)"}
    kinds = dict(plain.dtypes)
    return untyped_cell(plain, {name: kind for name, kind in read.items() if kinds.get(name) == "string"}, formats)


def clean_sales(sales: DataFrame, formats=calendar.ISO) -> DataFrame:
    """Plain headers, tax id root, amounts with a decimal comma, dates of the given formats."""
    plain, values = _plain_sales(sales, formats)
    return plain.withColumns(values)


def tagged_sales(sales: DataFrame, formats=calendar.ISO) -> DataFrame:
    """``clean_sales`` with its rejects in one pass: a column ``UNREAD`` keeps the texts of rows that cannot be read.

    Written once, it serves both: ``drop(UNREAD)`` are the clean sales, ``unread_sales`` the rejects.
    """
    plain, values = _plain_sales(sales, formats)
    texts = F.struct(*[F.col(name) for name in values])
    return plain.withColumn(UNREAD, F.when(_unreadable(plain, formats), texts)).withColumns(values)


def unread_sales(tagged: DataFrame) -> DataFrame:
    """The rejects of ``tagged_sales``, as ``untyped_sales`` has them."""
    kept = tagged.schema[UNREAD].dataType.names
    return tagged.filter(F.col(UNREAD).isNotNull()).withColumns({n: F.col(f"{UNREAD}.{n}") for n in kept}).drop(UNREAD)


def untyped_sales(sales: DataFrame, formats=calendar.ISO) -> DataFrame:
    """The raw sales with a filled date or amount that ``clean_sales`` cannot read."""
    plain = normalize_headers(sales)
    return plain.filter(_unreadable(plain, formats))


def clean_customers(customers: DataFrame, one_per_tax_id: bool = True) -> DataFrame:
    """Tax id root and name, three columns by position (and the row order, if there).

    By default one row per tax id, the first one with a name (or the first, if none has one), so that the join cannot
    multiply sales; else only whole-row copies go.
    """
    ordered = ROW_ORD in customers.columns
    body = [name for name in customers.columns if name != ROW_ORD]
    order = [F.col(ROW_ORD)] if ordered else []
    plain = rename_by_position(
        customers.select(*[customers[f"`{name}`"] for name in body], *order),
        CUSTOMER_COLUMNS + ([ROW_ORD] if ordered else []),
    ).withColumn("nit", tax_id_root(F.col("nit")))
    if one_per_tax_id:
        by = F.col(ROW_ORD) if ordered else F.struct("tipo_identificacion", "razon_social")
        named_first = F.struct((~is_filled(F.col("razon_social"))).alias("unnamed"), by.alias("place"))
        return first_by_key(plain, ["nit"], named_first).select("nit", "razon_social")
    return distinct_rows(plain.select(*CUSTOMER_COLUMNS)).drop("tipo_identificacion")


def sales_with_customer(sales: DataFrame, customers: DataFrame, excluded=rules.EXCLUDED_REFERENCES) -> DataFrame:
    """Sales without the excluded references, with the customer's name; null where the tax id is unknown."""
    kept = exclude_values(sales, "referencia", excluded).drop("razon_social")
    return left_lookup(kept, customers, "nit", keep=("razon_social",))


def unmatched_customers(sales: DataFrame, customers: DataFrame, excluded=rules.EXCLUDED_REFERENCES) -> DataFrame:
    """Sales rows without a customer name."""
    return sales_with_customer(sales, customers, excluded).filter(F.col("razon_social").isNull())


def sales_without_name(sales: DataFrame, customers: DataFrame, excluded=rules.EXCLUDED_REFERENCES) -> DataFrame:
    """``unmatched_customers`` for a register of one row per tax id: the distinct unknown tax ids are looked for, and only
    their sales are moved. Every row of a null tax id is one of them."""
    kept = exclude_values(sales, "referencia", excluded).drop("razon_social")
    named = customers.filter(F.col("razon_social").isNotNull()).select("nit")
    unknown = kept.select("nit").distinct().join(named, "nit", "left_anti").select(F.col("nit").alias("unknown_nit"))
    found = kept.join(unknown.filter("unknown_nit is not null"), F.col("nit") == F.col("unknown_nit"), "left_semi")
    return found.unionByName(kept.filter(F.col("nit").isNull())).withColumn("razon_social", F.lit(None).cast("string"))


def daily_revenue(sales: DataFrame) -> DataFrame:
    """Revenue by channel, customer and date; rows with a null key do not count, null amounts count as zero."""
    amounts = sales.select(
        F.col("linea_de_mercado").alias("canal"),
        F.col("razon_social").alias("customer_id"),
        F.col("fecha").alias("order_date"),
        cents(F.col("valor_bruto_local")).alias("cents"),
    )
    return _daily(amounts)


def _daily(amounts: DataFrame) -> DataFrame:
    keys = ["canal", "customer_id", "order_date"]
    return (
        complete(amounts, keys).groupBy(*keys).agg(F.coalesce(F.sum("cents"), F.lit(0)).alias("cents"))
    )


def daily_revenue_of(sales: DataFrame, customers: DataFrame, excluded=rules.EXCLUDED_REFERENCES) -> DataFrame:
    """``daily_revenue`` of ``sales_with_customer``, with the sales summed by tax id before they meet the customers.

    Summing first leaves at most one row per channel, tax id and date, so a tax id with very many sales does not make
    a hot key in the join. A tax id with several customer rows multiplies its sum, as it would multiply its sales.
    """
    keys = ["linea_de_mercado", "nit", "fecha"]
    kept = exclude_values(sales, "referencia", excluded).select(*keys, cents(F.col("valor_bruto_local")).alias("cents"))
    # rows without a tax id find no customer, and rows without a name do not count
    summed = complete(kept, keys).groupBy(*keys).agg(F.sum("cents").alias("cents"))
    named = summed.join(customers.filter(F.col("razon_social").isNotNull()), "nit")
    return _daily(
        named.select(
            F.col("linea_de_mercado").alias("canal"),
            F.col("razon_social").alias("customer_id"),
            F.col("fecha").alias("order_date"),
            "cents",
        )
    )


def rfm_metrics(daily: DataFrame, as_of: str | date | datetime | None = None, channels=rules.CHANNELS) -> DataFrame:
    """Days since the last purchase, number of purchase dates and revenue, by channel and customer.

    ``channels`` of None takes all channels; ``as_of`` of None is today.
    """
    wanted = daily if channels is None else daily.filter(F.col("canal").isin(*channels))
    grouped = wanted.groupBy("canal", "customer_id").agg(
        F.max("order_date").alias("last"), F.count("order_date").alias("purchase_dates"), F.sum("cents").alias("cents")
    )
    days = calendar.whole_days_between(calendar.moment(as_of), F.col("last"))
    return grouped.select("canal", "customer_id", days.alias("recency_days"), "purchase_dates", "cents")


def quintile_cuts(metrics: DataFrame) -> DataFrame:
    """The cuts ``k`` = 1 .. 4 per channel and measure, with linear interpolation between neighbours."""
    written = write_through(metrics.select("canal", "recency_days", "cents"), "metrics")
    found = order_statistics(written, "canal", ["recency_days", "cents"], PARTS).filter(
        F.col("k").between(1, PARTS - 1)
    )
    fifths = F.col("low") * (PARTS - F.col("remainder")) + F.col("high") * F.col("remainder")
    scale = F.when(F.col("measure") == "cents", PARTS * CENTS_PER_THOUSAND).otherwise(PARTS)
    value = (fifths / scale).cast("double")
    rank = (1 + (F.col("n") - 1) * F.col("k") / PARTS).cast("double")

    def cut(measure: str, column: Column) -> Column:
        return F.struct(F.lit(measure).alias("measure"), F.col("k"), column.alias("cut"))

    cuts = F.when(
        F.col("measure") == "cents", F.array(cut("monetary", value), cut("frequency", rank))
    ).otherwise(F.array(cut("recency", value)))
    return found.select("canal", F.inline(cuts))


def frequency_rank(metrics: DataFrame) -> DataFrame:
    """Rank of each customer in its channel by purchase dates, equal counts in the order of the customer id."""
    return rank_in_group(metrics, "canal", FREQUENCY_ORDER)


def _cut_table(metrics: DataFrame) -> DataFrame:
    """One row per channel: the customers, and for each measure the edges 0 .. 5 as arrays (low values, exact edges)."""
    found = order_statistics(metrics, "canal", ["recency_days", "cents"], PARTS)
    fifths = F.col("low") * (PARTS - F.col("remainder")) + F.col("high") * F.col("remainder")

    def edges(measure: str, value: Column):
        return [F.max(F.when((F.col("measure") == measure) & (F.col("k") == k), value)) for k in range(PARTS + 1)]

    return found.groupBy("canal").agg(
        F.max("n").alias("n"),
        *[
            F.array(*edges(measure, value)).alias(f"{measure}_{what}")
            for measure in ("recency_days", "cents")
            for what, value in (("low", F.col("low")), ("edge", fifths))
        ],
    )


def rfm_scores(metrics: DataFrame, on_ties: str = "compare") -> DataFrame:
    """Scores 1..5 per channel and customer.

    A score counts the cuts below the value. A cut lies between two neighbouring values, so a value is above the cut
    exactly when it is above the lower neighbour; no fraction is needed. Frequency is scored by rank, recency in reverse.
    ``on_ties="error"`` fails where two edges of a channel are equal.
    """
    ordered = sort_once(metrics, "canal", FREQUENCY_ORDER)
    # written, so that the join with a hot channel reads a plain exchange, which AQE splits or replaces by a broadcast
    ranked, cuts = rank_sorted(ordered, "canal"), write_through(_cut_table(ordered), "cuts")
    if on_ties == "error":
        tied = F.lit(False)
        for k in range(PARTS):
            for edges in ("recency_days_edge", "cents_edge"):
                tied = tied | (F.col(edges)[k] == F.col(edges)[k + 1])
            tied = tied | (F.col("n") == 1)
        checked = F.when(tied, F.raise_error(F.concat(F.lit("equal quintile edges in channel "), "canal")))
        cuts = cuts.withColumn("n", F.coalesce(checked.cast("bigint"), F.col("n")))
    scored = ranked.join(cuts, "canal")

    def above(conditions: list[Column]) -> Column:
        return sum((condition.cast("int") for condition in conditions[1:]), conditions[0].cast("int"))

    steps = range(1, PARTS)
    recency = above([F.col("recency_days") > F.col("recency_days_low")[k] for k in steps])
    frequency = above([(F.col("rank") - 1) * PARTS > (F.col("n") - 1) * k for k in steps])
    monetary = above([F.col("cents") > F.col("cents_low")[k] for k in steps])
    return scored.select(
        "canal",
        "customer_id",
        "recency_days",
        "purchase_dates",
        "cents",
        (PARTS - recency).alias("recency_score"),
        (1 + frequency).alias("frequency_score"),
        (1 + monetary).alias("monetary_score"),
    ).withColumn("rfm_score", F.expr("recency_score * 100 + frequency_score * 10 + monetary_score"))


def segment_of(score: Column, segments=rules.SEGMENT_OF_SCORE, otherwise: str = rules.NO_SEGMENT) -> Column:
    table = F.create_map(*[F.lit(part) for pair in segments.items() for part in pair])
    return F.coalesce(table[score.cast("int")], F.lit(otherwise))


def rfm_segments(
    daily: DataFrame, as_of: str | date | datetime | None = None, channels=rules.CHANNELS, on_ties: str = "compare"
) -> DataFrame:
    """The result table: one row per channel and customer, amounts in thousands."""
    scores = rfm_scores(rfm_metrics(daily, as_of, channels), on_ties)
    amount = F.col("cents") / F.lit(float(CENTS_PER_THOUSAND))
    return scores.select(
        F.col("customer_id").alias("id_cliente"),
        F.col("recency_days").alias("dias_recencia"),
        F.col("purchase_dates").alias("num_transacciones"),
        amount.alias("monto"),
        F.col("recency_score").alias("recencia_punt"),
        F.col("frequency_score").alias("frecuencia_punt"),
        F.col("monetary_score").alias("valor_punt"),
        F.col("rfm_score").alias("score_rfm"),
        "canal",
        segment_of(F.col("rfm_score")).alias("categoria"),
        amount.alias("ingresos"),
    )


def segment_customers(
    sales: DataFrame,
    customers: DataFrame,
    as_of: str | date | datetime | None = None,
    channels=rules.CHANNELS,
    excluded=rules.EXCLUDED_REFERENCES,
    one_per_tax_id: bool = True,
) -> DataFrame:
    """From the raw tables to the segments."""
    clean, register = clean_sales(sales), clean_customers(customers, one_per_tax_id)
    return rfm_segments(daily_revenue_of(clean, register, excluded), as_of, channels)
