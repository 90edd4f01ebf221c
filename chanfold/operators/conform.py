"""Silver layer: conform each channel's raw frame to the canonical fact.

rename -> normalize (one ``withColumns``) -> derive revenue / unit price ->
cast ids -> backfill missing columns -> ordered projection, then a strict
union of all channels.  Everything is narrow: no shuffle until the union is
consumed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

from chanfold.functions.months import MONTH_PARSERS
from chanfold.functions.recode import decode_flag, lower_status, recode, recode_code
from chanfold.specs import CHANNEL_SPECS, FACT_COLUMNS, ChannelSpec, channel_for_source

FACT_SCHEMA = StructType([
    StructField("channel", StringType()), StructField("consumer_id", StringType()),
    StructField("order_id", StringType()), StructField("country", StringType()),
    StructField("year_month", StringType()), StructField("category", StringType()),
    StructField("product_id", StringType()), StructField("qty_ordered", LongType()),
    StructField("qty_sold", LongType()), StructField("unit_price", DoubleType()),
    StructField("currency", StringType()), StructField("revenue_local", DoubleType()),
    StructField("order_status", StringType()), StructField("member", BooleanType()),
])


def flatten_lines(df: DataFrame, column: str = "lines") -> DataFrame:
    """One row per element of an array-of-struct column, struct fields as
    top-level columns.  ``inline_outer`` keeps an order whose list is empty
    or null as one row with null line fields."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.inline_outer(F.col(column)))


def rename_strict(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by map; a mapped column that is absent is an error (Spark's
    ``withColumnsRenamed`` would skip it silently)."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"columns to rename are missing: {missing}; present: {df.columns}")
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def normalize(df: DataFrame, spec: ChannelSpec) -> DataFrame:
    """All per-field normalizers of a channel in one projection; every
    expression reads the renamed input columns."""
    exprs = {}
    if spec.country_map:
        exprs["country"] = recode("country", spec.country_map)
    if spec.category_map:
        exprs["category"] = (recode_code("category", spec.category_map) if spec.category_is_code
                             else recode("category", spec.category_map))
    if spec.flag is not None:
        exprs["member"] = decode_flag("member", *spec.flag)
    if spec.status == "dict":
        exprs["order_status"] = recode("order_status", spec.status_map)
    else:
        exprs["order_status"] = lower_status("order_status")
    exprs["year_month"] = MONTH_PARSERS[spec.month]("year_month")
    return df.withColumns(exprs)


def derive_revenue(df: DataFrame) -> DataFrame:
    """Line revenue when the source lacks it: qty_sold x unit_price."""
    if "revenue_local" in df.columns:
        return df
    return df.withColumn("revenue_local", F.col("qty_sold") * F.col("unit_price"))


def derive_unit_price(df: DataFrame) -> DataFrame:
    """Unit price when the source lacks it: revenue / qty_sold for positive
    quantities, else null (no division by zero under ANSI)."""
    if "unit_price" in df.columns:
        return df
    return df.withColumn("unit_price", F.when(F.col("qty_sold") > 0,
                                              F.col("revenue_local") / F.col("qty_sold")))


def finalize(df: DataFrame, channel: str) -> DataFrame:
    """Channel literal, backfill of absent optional columns with typed nulls,
    canonical types (strict ANSI casts) and column order."""
    present = set(df.columns)
    cols = []
    for field in FACT_SCHEMA.fields:
        if field.name == "channel":
            cols.append(F.lit(channel).alias("channel"))
        elif field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name in ("consumer_id", "order_id", "member"):
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"channel {channel}: required column {field.name} is missing")
    return df.select(*cols)


def conform(raw: DataFrame, spec: ChannelSpec) -> DataFrame:
    """Canonicalize one channel (rename -> normalize -> derive -> finalize)."""
    df = raw
    if spec.nested_lines and spec.nested_lines in df.columns:
        df = flatten_lines(df, spec.nested_lines)
    df = rename_strict(df, spec.rename)
    df = normalize(df, spec)
    df = derive_revenue(df)
    df = derive_unit_price(df)
    return finalize(df, spec.channel)


def union_channels(frames: list[DataFrame]) -> DataFrame:
    """Vertical concat; names, order and types must agree exactly (Spark
    would otherwise widen int+double or string+bigint silently)."""
    if not frames:
        raise ValueError("no channel frames to union")
    first = frames[0].schema
    for i, f in enumerate(frames[1:], 1):
        a = [(x.name, x.dataType) for x in first.fields]
        b = [(x.name, x.dataType) for x in f.schema.fields]
        if a != b:
            raise ValueError(f"schema of frame {i} differs from frame 0: {b} vs {a}")
    return reduce(lambda x, y: x.union(y), frames)


def build_fact_orders(sources: dict[str, DataFrame]) -> DataFrame:
    """Silver fact from bronze frames keyed by source name (``retail_orders``
    ...).  Reference tables are skipped; an unknown source is an error."""
    frames = []
    for name in sorted(sources):
        channel = channel_for_source(name)
        if channel is None:
            continue
        frames.append(conform(sources[name], CHANNEL_SPECS[channel]))
    return union_channels(frames).select(*FACT_COLUMNS)


# Name used by the source system's API for the same step.
build_silver_layer = build_fact_orders
