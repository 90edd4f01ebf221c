"""Raw order files in each channel's own format, written from the driver
tables: retail CSV, ecomm NDJSON (nested), app JSON arrays, wholesale
Parquet, franchise workbooks, plus the rate table as CSV.

Written once per input snapshot into the shared work folder; every
file-source query reads them back through the bronze readers.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chanfold.plans import fixture_fact, raw_dialects
from chanfold.plans.layers import Layers, code_fingerprint, published
from chanfold.session import ship_package, work_dir
from chanfold.sources import xlsx

# Rows per written part file; bounds the memory of one JSON-array document
# and of one workbook.
ROWS_PER_FILE = 25_000

RAW_FILE_NAMES = {
    "retail": "retail_orders.csv",
    "ecomm": "ecomm_orders.ndjson",
    "app": "app_orders.json",
    "wholesale": "wholesale_orders.parquet",
    "franchise": "franchise_orders.xlsx",
    "currency_reference": "currency_reference.csv",
}


def _parts(df: DataFrame, approx_rows: int | None = None) -> DataFrame:
    """Repartition so that no part file exceeds ``ROWS_PER_FILE`` rows on
    average; the row count is one cheap aggregate over the encoded frame."""
    n = approx_rows if approx_rows is not None else df.count()
    return df.repartition(max(1, -(-n // ROWS_PER_FILE)))


def _bounded(df: DataFrame):
    """Writer whose part files hold ``ROWS_PER_FILE`` rows at most.  Each task
    starts a new file when one is full, so nothing is counted or shuffled."""
    return df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)


def write_json_array(df: DataFrame, path: str) -> None:
    """JSON array documents (Spark's writer only emits JSON lines): each task
    joins its rows into ``[...]``, ``ROWS_PER_FILE`` at most in a document."""
    write_json_documents(df.select(F.to_json(F.struct(*df.columns)).alias("j")), path)


def write_json_documents(lines: DataFrame, path: str) -> None:
    """The JSON texts ``j`` as arrays of at most ``ROWS_PER_FILE``, a file each."""
    ship_package(lines.sparkSession)
    most = ROWS_PER_FILE

    def run(batches):
        held = []
        for b in batches:
            held += b["j"].tolist()
            while len(held) >= most:
                yield pd.DataFrame({"value": ["[" + ",".join(held[:most]) + "]"]})
                held = held[most:]
        if held:
            yield pd.DataFrame({"value": ["[" + ",".join(held) + "]"]})

    lines.mapInPandas(run, "value string").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_raw_files(layers: Layers, target: str) -> None:
    fact = layers.fact()
    enc = {ch: fn(fact) for ch, fn in raw_dialects.RAW_ENCODERS.items()}
    names = RAW_FILE_NAMES
    writes = [
        lambda: _bounded(enc["retail"]).option("header", True).csv(f"{target}/{names['retail']}"),
        lambda: _bounded(enc["ecomm"]).json(f"{target}/{names['ecomm']}"),
        lambda: write_json_array(enc["app"], f"{target}/{names['app']}"),
        lambda: _bounded(enc["wholesale"]).parquet(f"{target}/{names['wholesale']}"),
        lambda: xlsx.write_xlsx(enc["franchise"], f"{target}/{names['franchise']}", ROWS_PER_FILE),
        lambda: layers.rates().coalesce(1).write.mode("overwrite").option("header", True).csv(
            f"{target}/{names['currency_reference']}")]
    # Independent jobs: submitted from driver threads, so that they share the cluster.
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(w) for w in writes]:
            done.result()


def mixed_types(app: DataFrame) -> DataFrame:
    """App records as JSON texts in which some cells have another type: product
    ids as text, amounts as objects, units sold as words."""
    n = F.col("qty")
    rest = F.to_json(F.struct(*[c for c in app.columns if c not in ("productId", "amount", "sold")]))
    cell = lambda c, *odd: F.coalesce(*[F.when(w, v) for w, v in odd], F.col(c).cast("string"), F.lit("null"))
    return app.select(F.concat(
        F.expr("'{\"productId\":'"), cell("productId", (n % 5 == 2, F.concat(F.lit('"'), F.col("productId"), F.lit('"')))),
        F.lit(',"amount":'), cell("amount", (n % 11 == 4, F.lit('{"value":1}'))),
        F.lit(',"sold":'), cell("sold", (n % 7 == 3, F.lit('"dos"'))),
        F.lit(","), F.substring(rest, 2, 1_000_000)).alias("j"))


def mixed_json_folder(layers: Layers) -> str:
    """JSON arrays of app records with mixed types, written once per snapshot."""
    return published(layers.spark, f"{work_dir(layers.spark)}/chanfold-mixed",
                     _fingerprint(layers) + code_fingerprint(mixed_types, write_json_documents),
                     lambda folder: write_json_documents(
                         mixed_types(raw_dialects.RAW_ENCODERS["app"](layers.fact())), folder))


def late_misfits(retail: DataFrame) -> DataFrame:
    """Retail records as text, with words for units in some of the last orders."""
    order = F.col("transaction_id").cast("bigint")
    last = retail.agg(F.max(order)).first()[0] or 0
    late = (order > F.lit(last) * 0.9) & (F.col("units_ordered") % 7 == 3)
    cells = [F.when(late, F.lit("tres")).otherwise(F.col(c).cast("string")).alias(c) if c == "units_ordered"
             else F.col(c) for c in retail.columns]
    return retail.select(*cells).orderBy(order, "sku", "units_sold")


def late_misfit_folder(layers: Layers) -> str:
    """CSV files in the order of the order numbers, written once per snapshot."""
    return published(layers.spark, f"{work_dir(layers.spark)}/chanfold-untyped",
                     _fingerprint(layers) + code_fingerprint(late_misfits),
                     lambda folder: late_misfits(raw_dialects.RAW_ENCODERS["retail"](layers.fact()))
                     .write.option("header", True).csv(folder))


# Sources written in folders by a column: source -> (format, column).
FOLDERED = {"retail": (".csv", "order_month"), "ecomm": (".ndjson", "period"), "wholesale": (".parquet", "country_code")}


def write_foldered(layers: Layers, target: str) -> None:
    for source, (suffix, column) in FOLDERED.items():
        writer = _parts(raw_dialects.RAW_ENCODERS[source](layers.fact())).write.partitionBy(column)
        out = f"{target}/{source}_orders{suffix}"
        {".csv": writer.option("header", True).csv, ".ndjson": writer.json, ".parquet": writer.parquet}[suffix](out)


def foldered(layers: Layers) -> str:
    """Raw sources with one folder per month or country, written once per snapshot."""
    return published(layers.spark, f"{work_dir(layers.spark)}/chanfold-foldered",
                     _fingerprint(layers) + code_fingerprint(write_foldered),
                     lambda folder: write_foldered(layers, folder))


def _fingerprint(layers: Layers) -> str:
    """Of the input tables and of all code and dictionaries that encode them."""
    from chanfold import specs
    from chanfold.functions import arith, months
    from chanfold.functions import recode_mod as recode
    from chanfold.operators import fx
    fp = layers.fingerprint(["lineitem", "orders", "customer", "part"], fixture_fact, raw_dialects,
                            xlsx, specs, recode, arith, months, fx)
    return fp + code_fingerprint(write_raw_files, write_json_array, write_json_documents)


def raw_folder(layers: Layers) -> str:
    """Folder with the six raw sources, written on first use per snapshot."""
    return published(layers.spark, f"{work_dir(layers.spark)}/chanfold-raw", _fingerprint(layers),
                     lambda folder: write_raw_files(layers, folder))


def bronze_folder(layers: Layers) -> str:
    """Folder with all raw sources ingested, written once per snapshot."""
    from chanfold.sources import ingest, readers, versions
    raw_dir = raw_folder(layers)
    return published(layers.spark, f"{work_dir(layers.spark)}/chanfold-bronze",
                     _fingerprint(layers) + code_fingerprint(ingest, readers, versions),
                     lambda folder: ingest.ingest_all(layers.spark, raw_dir, folder, declared_schemas()))


def declared_schemas() -> dict[str, str]:
    """Schemas by source name for the bronze readers."""
    out = {f"{ch}_orders": s for ch, s in raw_dialects.RAW_SCHEMAS.items()
           if ch != "currency_reference"}
    out["currency_reference"] = raw_dialects.RAW_SCHEMAS["currency_reference"]
    return out
