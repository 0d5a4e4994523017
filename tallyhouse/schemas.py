"""Input schemas and the check for required columns.

Every input arrives as text and is typed by an explicit step; ``row_ord`` is added by the readers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import calendar, text

ROW_ORD = "row_ord"


class MissingColumns(ValueError):
    """An input lacks columns that the operator needs."""


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; there are {df.columns}")
    return df


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


# column -> type after the typing step
SALES = {
    "Marca": "string",
    "Linea de mercado": "string",
    "Razon social": "string",
    "Fecha": "timestamp_ntz",
    "Referencia": "string",
    "EAN 13": "string",
    "Desc. item": "string",
    "U.M.": "string",
    "Cantidad inv.": "bigint",
    "Valor bruto local": "decimal(18,2)",
    "Nit": "string",
}
SALES_RFM = {
    "nit": "string",
    "referencia": "string",
    "linea_de_mercado": "string",
    "fecha": "timestamp_ntz",
    "valor_bruto_local": "decimal(18,2)",
}
CUSTOMERS = {"tipo_identificacion": "string", "nit": "string", "razon_social": "string"}
COSTS_NEW = {
    "Marca": "string",
    "Referencia": "string",
    "Desc. item": "string",
    "Instalación": "string",
    "U.M.": "string",
    "Costo prom. uni.": "decimal(18,4)",
    "Mes": "string",
    "Año": "int",
}
COSTS_HISTORY = {
    "Referencia": "string",
    "Desc.item": "string",
    "Instalación": "string",
    "U.M.": "string",
    "Costo prom.": "decimal(18,4)",
    "Mes": "string",
    "Año": "int",
}
PRODUCT_FAMILY = {"Referencia": "string", "Marca": "string", "Incluir referencia(Si/No)": "string"}
SELLOUT_HISTORY = {"Mes": "string", "año": "int", "cliente": "string", "Unidades": "bigint", "NumMes": "int"}
SELLOUT_CITY = {
    "EAN": "string",
    "cliente": "string",
    "Mes": "string",
    "año": "int",
    "Tienda": "string",
    "Ciudad": "string",
    "Descripcion": "string",
    "Unidades": "bigint",
    "NumMes": "int",
}
SELLOUT_CHAIN = {
    "EAN": "string",
    "Fecha": "timestamp_ntz",
    "Nomb. Dependencia": "string",
    "Descripción": "string",
    "Unidades": "bigint",
}
SELLOUT_PHARMACY = {
    "UPC": "string",
    "NOMBRE_TIENDA": "string",
    "CIUDAD": "string",
    "DESCRIPCION_ITEM": "string",
    "UNIDADES_VENDIDAS": "bigint",
    "SUP_NAME": "string",
}
LANDED_FILES = {"file_name": "string", "client_key": "string"}


def typed_value(column: Column, type_name: str, date_formats=calendar.ISO) -> Column:
    """A text cell as ``type_name``; null if it does not fit."""
    if type_name == "string":
        return column.cast("string")
    if type_name.startswith("timestamp"):
        return calendar.parse_timestamp(column, date_formats)
    if type_name.startswith("decimal"):
        return F.replace(text.strip(column), F.lit(","), F.lit(".")).try_cast(type_name)
    if type_name == "bigint":
        return whole_number(column)
    return text.strip(column).try_cast(type_name)


def whole_number(cell: Column) -> Column:
    """A whole number, also as sheets write it (``4.0``); null for a fraction, for what is no number and for what 64 bits
    do not hold."""
    stripped = text.strip(cell.cast("string"))
    number = stripped.try_cast("decimal(28,6)")
    return F.coalesce(stripped.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))


def apply_types(df: DataFrame, schema: dict[str, str], date_formats=calendar.ISO) -> DataFrame:
    """Type the columns of ``schema`` in one projection; other columns pass."""
    require_columns(df, schema)
    return df.select(
        *[
            typed_value(df[f"`{name}`"], schema[name], date_formats).alias(name) if name in schema else df[f"`{name}`"]
            for name in df.columns
        ]
    )


def untyped_rows(df: DataFrame, schema: dict[str, str], date_formats=calendar.ISO) -> DataFrame:
    """The rows with a filled cell that does not fit its type: the rejects of the typing step."""
    return df.filter(untyped_cell(df, schema, date_formats))


def untyped_cell(df: DataFrame, schema: dict[str, str], date_formats=calendar.ISO) -> Column:
    bad = F.lit(False)
    for name, type_name in schema.items():
        if type_name != "string":
            cell = df[f"`{name}`"]
            bad = bad | (text.is_filled(cell) & typed_value(cell, type_name, date_formats).isNull())
    return bad
