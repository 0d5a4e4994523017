"""Product descriptions: brand, pack size, product name, units per pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions.text import BLANK, collapse_blanks, replace_words, strip

_PACK_AFTER_BLANK = rf"{BLANK}+X{BLANK}*\d"
_PACK_SIZE = rf"(?iU)X{BLANK}*(\d[^\s\x1c-\x1f]*)"


def brand_from_prefix(description: Column, brand: Column, prefixes=rules.BRAND_PREFIXES) -> Column:
    """Keep the brand; where it is null, take it from the first prefix that fits the description."""
    found = F.lit(None).cast("string")
    for prefix, name in reversed(prefixes):
        found = F.when(F.startswith(description, F.lit(prefix)), F.lit(name)).otherwise(found)
    return F.coalesce(brand, found)


def has_pack(description: Column) -> Column:
    return F.coalesce(description.rlike(f"(?iU){_PACK_AFTER_BLANK}"), F.lit(False))


def pack_size(description: Column) -> Column:
    """The digits after the first X with what follows up to a blank, else the text for "no pack"."""
    found = F.regexp_extract(description, _PACK_SIZE, 1)
    return F.when(found != "", found).otherwise(F.lit(rules.MISSING_PACK))


def product_name(description: Column, ignore_case: bool = False) -> Column:
    """The text before the pack size. By default only an upper-case X starts a pack here."""
    flags = "(?iU)" if ignore_case else "(?U)"
    return strip(F.split(description, flags + _PACK_AFTER_BLANK, 2)[0])


def normalize_pack(pack: Column, replacements=rules.PACK_REPLACEMENTS) -> Column:
    upper = strip(F.upper(pack))
    return F.when(upper != "", collapse_blanks(replace_words(upper, replacements))).otherwise(
        F.lit(rules.MISSING_PACK)
    )


def default_pack(pack: Column, description: Column) -> Column:
    """A described product without a pack size is sold by the piece."""
    return F.when((pack == rules.MISSING_PACK) & description.isNotNull(), F.lit(rules.DEFAULT_PACK)).otherwise(pack)


def with_pack_and_product(
    df: DataFrame, description: str, pack: str, product: str, product_rules: rules.ProductRules = rules.ProductRules()
) -> DataFrame:
    """Add the normalised pack and product of a description.

    The steps are separate projections: a step uses the one before more than once, and nested they would multiply.
    """
    column = F.col(f"`{description}`")
    name = product_name(column, product_rules.ignore_case_in_name)
    steps = df.withColumns({pack: strip(F.upper(pack_size(column))), product: strip(F.upper(name))})
    steps = steps.withColumns(
        {
            pack: collapse_blanks(replace_words(F.col(pack), product_rules.packs)),
            product: collapse_blanks(replace_words(F.col(product), product_rules.replacements)),
        }
    )
    return steps.withColumn(pack, default_pack(F.col(pack), column))


def sold_units(units: Column, customer: Column, brand: Column, pack: Column, rule=rules.PackRule()) -> Column:
    """Units in pieces: the one customer and brand of the rule are invoiced in packs."""
    table = F.create_map(*[F.lit(part) for pair in rule.units for part in pair])
    in_packs = F.coalesce((customer == rule.customer) & (brand == rule.brand), F.lit(False))
    return F.when(in_packs, units * F.coalesce(table[pack], F.lit(rule.otherwise))).otherwise(units).cast("bigint")
