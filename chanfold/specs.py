"""Channel specifications and the code dictionaries they use (data only).

What differs between sales channels is kept here as data; the generic
conform plan in ``chanfold.operators.conform`` applies it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source system's dictionaries exactly,
# so they are written out as plain text in their natural order.
# ---------------------------------------------------------------------------

FACT_COLUMNS = [
    "channel", "consumer_id", "order_id", "country", "year_month",
    "category", "product_id", "qty_ordered", "qty_sold", "unit_price",
    "currency", "revenue_local", "order_status", "member",
]

COUNTRY_NAME_TO_ISO2 = {
    "Brazil": "BR", "Mexico": "MX", "Colombia": "CO",
    "Chile": "CL", "Argentina": "AR", "Peru": "PE",
}
COUNTRY_ISO3_TO_ISO2 = {
    "BRA": "BR", "MEX": "MX", "COL": "CO",
    "PER": "PE", "ARG": "AR", "CHL": "CL",
}
CATEGORY_FIX = {
    "Runing": "Running", "Outdor": "Outdoor",
    "Footbal": "Football", "Originls": "Originals",
    "Running": "Running", "Outdoor": "Outdoor",
    "Football": "Football", "Originals": "Originals",
}
ECOMM_CATCODE_TO_CATEGORY = {1: "Running", 2: "Outdoor", 3: "Football", 4: "Originals"}
WHOLESALE_CATCODE_TO_CATEGORY = {"RUN": "Running", "OUT": "Outdoor", "FBL": "Football", "ORG": "Originals"}
SPANISH_MONTH_TO_NUM = {
    "Ene": "01", "Feb": "02", "Mar": "03", "Abr": "04",
    "May": "05", "Jun": "06", "Jul": "07", "Ago": "08",
    "Sep": "09", "Oct": "10", "Nov": "11", "Dic": "12",
}
FRANCHISE_STATUS_MAP = {
    "En proceso": "processing", "Entregado": "delivered",
    "Cancelado": "cancelled", "Devuelto": "returned",
}
REAL_SALE_STATUSES = ["delivered", "returned"]

RETAIL_RENAME = {
    "consumer_id": "consumer_id", "store_country": "country",
    "order_month": "year_month", "product_category": "category",
    "sku": "product_id", "units_ordered": "qty_ordered",
    "units_sold": "qty_sold", "unit_price": "unit_price",
    "currency": "currency", "transaction_id": "order_id",
    "loyalty_flag": "member", "order_state": "order_status",
}
ECOMM_RENAME = {
    "customerId": "consumer_id", "market": "country",
    "period": "year_month", "orderId": "order_id",
    "currency": "currency", "adiClub": "member", "status": "order_status",
    "catCode": "category", "article": "product_id",
    "qtyOrd": "qty_ordered", "qtySold": "qty_sold", "priceFinal": "unit_price",
}
APP_RENAME = {
    "uid": "consumer_id", "cc": "country", "yearmonth": "year_month",
    "category": "category", "productId": "product_id", "qty": "qty_ordered",
    "sold": "qty_sold", "amount": "revenue_local", "currency": "currency",
    "orderRef": "order_id", "member": "member", "fulfillment": "order_status",
}
WHOLESALE_RENAME = {
    "country_code": "country", "category_code": "category",
    "yr_month": "year_month",
    "material_id": "product_id", "sell_in_units": "qty_ordered",
    "sell_out_units": "qty_sold", "avg_price": "unit_price",
    "currency": "currency", "status": "order_status",
}
FRANCHISE_RENAME = {
    "Consumidor": "consumer_id", "Pais": "country", "Mes": "year_month",
    "Categoria": "category", "Codigo_Producto": "product_id",
    "Cant_Pedida": "qty_ordered", "Cant_Vendida": "qty_sold",
    "Precio_Unitario": "unit_price", "Moneda": "currency",
    "Num_Orden": "order_id", "AdiClub": "member", "Estado_Orden": "order_status",
}

# Member-flag encodings: (value meaning true, value meaning false or None).
# Anything else -- including a missing false value -- becomes null.
RETAIL_FLAG = ("Y", "N")
FRANCHISE_FLAG = ("Si", "No")
APP_FLAG = ("Y", None)

# End of fixed values.
# ---------------------------------------------------------------------------

# Tables that live next to the order sources but are not channels.  Any
# other unknown source name is an error instead of being skipped silently.
REFERENCE_SOURCES = {"currency_reference"}


@dataclass(frozen=True)
class ChannelSpec:
    """Everything that differs between channels when conforming a source.

    ``month`` names the month dialect: ``iso`` (already YYYY-MM),
    ``spanish`` (``Abr-2025``), ``int`` (202503), ``slash`` (``2025/03``) or
    ``timestamp``.  ``status`` is ``lower`` or ``dict``.
    """

    channel: str
    rename: dict
    month: str
    country_map: dict | None = None
    category_map: dict | None = None
    category_is_code: bool = False
    flag: tuple | None = None
    status: str = "lower"
    status_map: dict | None = None
    nested_lines: str | None = None
    source_format: str = "parquet"
    id_columns: tuple = field(default=("consumer_id", "order_id", "product_id"))


CHANNEL_SPECS: dict[str, ChannelSpec] = {
    "retail": ChannelSpec(
        channel="retail", rename=RETAIL_RENAME, month="iso",
        country_map=COUNTRY_NAME_TO_ISO2, category_map=CATEGORY_FIX,
        flag=RETAIL_FLAG, source_format="csv"),
    "ecomm": ChannelSpec(
        channel="ecomm", rename=ECOMM_RENAME, month="int",
        category_map={str(k): v for k, v in ECOMM_CATCODE_TO_CATEGORY.items()},
        category_is_code=True, nested_lines="lines", source_format="ndjson"),
    "app": ChannelSpec(
        channel="app", rename=APP_RENAME, month="slash",
        country_map=COUNTRY_ISO3_TO_ISO2, category_map=CATEGORY_FIX,
        flag=APP_FLAG, source_format="json"),
    "wholesale": ChannelSpec(
        channel="wholesale", rename=WHOLESALE_RENAME, month="timestamp",
        category_map=WHOLESALE_CATCODE_TO_CATEGORY, category_is_code=True,
        source_format="parquet"),
    "franchise": ChannelSpec(
        channel="franchise", rename=FRANCHISE_RENAME, month="spanish",
        category_map=CATEGORY_FIX, flag=FRANCHISE_FLAG, status="dict",
        status_map=FRANCHISE_STATUS_MAP, source_format="xlsx"),
}


def channel_for_source(source_name: str) -> str | None:
    """``retail_orders`` -> ``retail``; reference tables -> None; else error."""
    if source_name in REFERENCE_SOURCES:
        return None
    channel = source_name.replace("_orders", "")
    if channel not in CHANNEL_SPECS:
        raise ValueError(
            f"source {source_name!r} maps to no channel spec; known channels: "
            f"{sorted(CHANNEL_SPECS)}; reference tables: {sorted(REFERENCE_SOURCES)}")
    return channel
