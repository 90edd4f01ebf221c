"""Each channel's raw source schema, encoded from the derived fact.

The source system receives five differently shaped order files; they are not
available, so each is re-created from the derived fact (FIXTURES.md
section 5) with the inverse of the channel's dictionaries.  Conforming such
a frame must give back the derived fact rows of that channel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chanfold.functions.recode import literal_map
from chanfold.sources.readers import schema_columns  # noqa: F401  (used by the registry)
from chanfold.specs import (CATEGORY_FIX, COUNTRY_ISO3_TO_ISO2, COUNTRY_NAME_TO_ISO2,
                            ECOMM_CATCODE_TO_CATEGORY, FRANCHISE_STATUS_MAP,
                            SPANISH_MONTH_TO_NUM, WHOLESALE_CATCODE_TO_CATEGORY)


def _inverse(mapping: dict) -> dict:
    return {v: k for k, v in mapping.items()}


def _misspelt_category() -> F.Column:
    """Every tenth product (by id) carries the typo the dictionary repairs."""
    typo = {v: k for k, v in CATEGORY_FIX.items() if k != v}
    return (F.when(F.col("product_id").cast("bigint") % 10 == 0,
                   F.coalesce(F.try_element_at(literal_map(typo), F.col("category")), F.col("category")))
             .otherwise(F.col("category")))


def _of(fact: DataFrame, channel: str) -> DataFrame:
    return fact.filter(F.col("channel") == channel)


def retail_raw(fact: DataFrame) -> DataFrame:
    f = _of(fact, "retail")
    return f.select(
        F.col("order_id").alias("transaction_id"),
        "consumer_id",
        F.try_element_at(literal_map(_inverse(COUNTRY_NAME_TO_ISO2)), F.col("country")).alias("store_country"),
        F.col("year_month").alias("order_month"),
        _misspelt_category().alias("product_category"),
        F.col("product_id").alias("sku"),
        F.col("qty_ordered").alias("units_ordered"),
        F.col("qty_sold").alias("units_sold"),
        "unit_price", "currency",
        F.when(F.col("member"), "Y").when(~F.col("member"), "N").otherwise("?").alias("loyalty_flag"),
        F.upper("order_status").alias("order_state"),
    )


LINE_FIELDS = ["catCode", "article", "qtyOrd", "qtySold", "priceFinal"]
ECOMM_ORDER_FIELDS = ["orderId", "customerId", "market", "period", "currency", "adiClub", "status"]


def ecomm_lines_flat(fact: DataFrame) -> DataFrame:
    """Ecomm rows in raw column names, one per order line (before nesting)."""
    f = _of(fact, "ecomm")
    return f.select(
        F.col("order_id").alias("orderId"),
        F.col("consumer_id").alias("customerId"),
        F.col("country").alias("market"),
        F.regexp_replace("year_month", "-", "").cast("bigint").alias("period"),
        "currency",
        F.col("member").alias("adiClub"),
        F.col("order_status").alias("status"),
        F.try_element_at(literal_map({v: str(k) for k, v in ECOMM_CATCODE_TO_CATEGORY.items()}),
                         F.col("category")).cast("bigint").alias("catCode"),
        F.col("product_id").alias("article"),
        F.col("qty_ordered").alias("qtyOrd"),
        F.col("qty_sold").alias("qtySold"),
        F.col("unit_price").alias("priceFinal"),
    )


def ecomm_raw(fact: DataFrame) -> DataFrame:
    """Nested ecomm orders: one record per (order, customer, market, period,
    currency, flag, status) with its lines as an array of structs.  A record is
    one document of the source system, so an order is never split."""
    return ecomm_lines_flat(fact).groupBy(*ECOMM_ORDER_FIELDS).agg(
        F.collect_list(F.struct(*LINE_FIELDS)).alias("lines"))


def app_raw(fact: DataFrame) -> DataFrame:
    f = _of(fact, "app")
    return f.select(
        F.col("consumer_id").alias("uid"),
        F.try_element_at(literal_map(_inverse(COUNTRY_ISO3_TO_ISO2)), F.col("country")).alias("cc"),
        F.regexp_replace("year_month", "-", "/").alias("yearmonth"),
        _misspelt_category().alias("category"),
        F.col("product_id").cast("bigint").alias("productId"),
        F.col("qty_ordered").alias("qty"),
        F.col("qty_sold").alias("sold"),
        F.col("revenue_local").alias("amount"),
        "currency",
        F.col("order_id").alias("orderRef"),
        F.when(F.col("member"), "Y").otherwise("N").alias("member"),
        F.initcap("order_status").alias("fulfillment"),
    )


def wholesale_raw(fact: DataFrame) -> DataFrame:
    f = _of(fact, "wholesale")
    return f.select(
        F.col("country").alias("country_code"),
        F.try_element_at(literal_map(_inverse(WHOLESALE_CATCODE_TO_CATEGORY)),
                         F.col("category")).alias("category_code"),
        F.to_timestamp_ntz(F.concat("year_month", F.lit("-01")), F.lit("yyyy-MM-dd")).alias("yr_month"),
        F.col("product_id").alias("material_id"),
        F.col("qty_ordered").alias("sell_in_units"),
        F.col("qty_sold").alias("sell_out_units"),
        F.col("unit_price").alias("avg_price"),
        "currency",
        F.col("order_status").alias("status"),
    )


def franchise_raw(fact: DataFrame) -> DataFrame:
    f = _of(fact, "franchise")
    month_es = F.try_element_at(literal_map(_inverse(SPANISH_MONTH_TO_NUM)),
                                F.substring("year_month", 6, 2))
    return f.select(
        F.col("order_id").alias("Num_Orden"),
        F.col("consumer_id").alias("Consumidor"),
        F.col("country").alias("Pais"),
        F.concat(month_es, F.lit("-"), F.substring("year_month", 1, 4)).alias("Mes"),
        _misspelt_category().alias("Categoria"),
        F.col("product_id").alias("Codigo_Producto"),
        F.col("qty_ordered").alias("Cant_Pedida"),
        F.col("qty_sold").alias("Cant_Vendida"),
        F.col("unit_price").alias("Precio_Unitario"),
        F.col("currency").alias("Moneda"),
        F.when(F.col("member"), "Si").when(~F.col("member"), "No").otherwise("?").alias("AdiClub"),
        F.try_element_at(literal_map(_inverse(FRANCHISE_STATUS_MAP)),
                         F.col("order_status")).alias("Estado_Orden"),
    )


RAW_ENCODERS = {
    "retail": retail_raw,
    "ecomm": ecomm_raw,
    "app": app_raw,
    "wholesale": wholesale_raw,
    "franchise": franchise_raw,
}


# Declared schemas of the raw files (the readers never guess these).
RAW_SCHEMAS = {
    "retail": ("transaction_id string, consumer_id string, store_country string, "
               "order_month string, product_category string, sku string, units_ordered bigint, "
               "units_sold bigint, unit_price double, currency string, loyalty_flag string, "
               "order_state string"),
    "ecomm": ("orderId string, customerId string, market string, period bigint, currency string, "
              "adiClub boolean, status string, lines array<struct<catCode: bigint, article: string, "
              "qtyOrd: bigint, qtySold: bigint, priceFinal: double>>"),
    "app": ("uid string, cc string, yearmonth string, category string, productId bigint, "
            "qty bigint, sold bigint, amount double, currency string, orderRef string, "
            "member string, fulfillment string"),
    "wholesale": ("country_code string, category_code string, yr_month timestamp_ntz, "
                  "material_id string, sell_in_units bigint, sell_out_units bigint, "
                  "avg_price double, currency string, status string"),
    "franchise": ("Num_Orden string, Consumidor string, Pais string, Mes string, Categoria string, "
                  "Codigo_Producto string, Cant_Pedida bigint, Cant_Vendida bigint, "
                  "Precio_Unitario double, Moneda string, AdiClub string, Estado_Orden string"),
    "currency_reference": ("country string, year_month string, currency_from string, "
                           "currency_to string, local_units_per_eur double"),
}
