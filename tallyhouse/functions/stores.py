"""Store and city out of the store names in the retailers' reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.functions.text import strip


def _pair(store: Column, city: Column) -> Column:
    return F.struct(store.alias("store"), city.alias("city"))


def _known(exceptions) -> Column:
    parts = [part for name, store, city in exceptions for part in (F.lit(name), _pair(F.lit(store), F.lit(city)))]
    return F.create_map(*parts)


def store_city_chain(name: Column, exceptions=rules.CHAIN_STORES) -> Column:
    """``STORE - CITY``; known names first, no dash means an unknown city, a third part is dropped."""
    split = _pair(strip(F.split_part(name, F.lit("-"), F.lit(1))), strip(F.split_part(name, F.lit("-"), F.lit(2))))
    whole = F.when(name.isNotNull(), _pair(strip(name), F.lit(rules.UNKNOWN_CITY)))
    return F.coalesce(_known(exceptions)[strip(name)], F.when(F.contains(name, F.lit("-")), split).otherwise(whole))


def without_code(name: Column) -> Column:
    """The store name in upper case, without the code up to the first dash."""
    # position 0 means no dash, and then the text from 0 + 1 is all of it
    return F.upper(strip(F.substr(name, F.instr(name, "-") + F.lit(1))))


def store_city_by_last_dash(name: Column, exceptions=rules.WHOLESALE_STORES) -> Column:
    """A name from ``without_code``: the last `` - `` parts store and city, else it is a city's only store."""
    city = F.substring_index(name, " - ", -1)
    store = F.left(name, F.length(name) - F.length(city) - F.lit(3))
    whole = F.when(name.isNull(), _pair(F.lit(""), F.lit(""))).otherwise(_pair(F.lit(rules.ONLY_STORE), name))
    split = F.when(F.contains(name, F.lit(" - ")), _pair(strip(store), strip(city))).otherwise(whole)
    return F.coalesce(_known(exceptions)[name], split)


def store_city_wholesale(name: Column, exceptions=rules.WHOLESALE_STORES) -> Column:
    """``CODE-Store - City``."""
    return store_city_by_last_dash(without_code(name), exceptions)
