"""Source discovery and format readers.

Discovery lists the raw folder with the ``binaryFile`` source (metadata
columns only; the file content is pruned from the scan) and keeps the
top-level entries whose suffix names a known format.  An entry is a single
file or a folder of part files as Spark writes them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from chanfold.sources.xlsx import read_xlsx

# Timestamp pattern used when a CSV schema has to be inferred: with a time
# part required, month text such as ``2025-01`` stays a string instead of
# being read as a timestamp.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return (r.option("inferSchema", True).option("timestampFormat", CSV_TIMESTAMP_FORMAT)
             .option("preferDate", False).csv(path))


CORRUPT = "_corrupt_record"


def infer_csv_schema(spark: SparkSession, path: str, sample_rows: int = 10_000) -> StructType:
    """Schema of a CSV source from its first ``sample_rows`` rows: of a folder,
    those of its first part files by name, as many as that takes.

    A column is bigint, double or boolean if all of its sampled values that are
    not null read as that (in this order), else string; a column without values
    is a string.  One aggregation over the sampled rows decides for all columns,
    and one row reaches the driver."""
    raw = spark.read.option("header", True).option("inferSchema", False)
    files = sorted(raw.csv(path).inputFiles())
    taken, total = [], 0
    for f in files:                                # headers only differ by file; each is counted once
        taken.append(f)
        total += raw.csv(f).limit(sample_rows - total).count()
        if total >= sample_rows:
            break
    if not taken:
        return raw.csv(path).schema
    last = raw.csv(taken[-1])
    names = last.columns
    rows = last.limit(sample_rows - (raw.csv(taken[:-1]).count() if len(taken) > 1 else 0))
    if len(taken) > 1:
        rows = raw.csv(taken[:-1]).unionByName(rows)
    reads = {"long": lambda c: c.rlike(r"^[+-]?[0-9]{1,18}$"),
             "double": lambda c: c.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
             "boolean": lambda c: F.lower(c).isin("true", "false")}
    seen = rows.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)],
                    *[F.count_if(~fits(F.col(f"`{c}`"))).alias(f"{kind}{i}")
                      for i, c in enumerate(names) for kind, fits in reads.items()]).first()
    out = StructType()
    for i, c in enumerate(names):
        kinds = [k for k in reads if seen[f"n{i}"] and not seen[f"{k}{i}"]]
        out.add(c, kinds[0] if kinds else "string")
    return out


def read_csv_sampled(spark: SparkSession, path: str, sample_rows: int = 10_000,
                     observation: Observation | None = None) -> DataFrame:
    """A CSV source without a declared schema, typed by its first rows.

    Rows with a value that does not read as its column's type are all returned:
    that value is null and ``_corrupt_record`` holds the row's text (null for
    all other rows).  ``observation`` gets their number, ``misfit_rows``, and
    ``rows`` from the job that reads them."""
    schema = infer_csv_schema(spark, path, sample_rows).add(CORRUPT, "string")
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path))
    if observation is None:
        return df
    return df.observe(observation, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col(CORRUPT).isNotNull()).alias("misfit_rows"))


def read_ndjson(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_json_array(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A JSON document per file (an array of objects).  ``multiLine`` parses
    each file whole, so one file is one task: writers keep files bounded."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


MISFITS = "_misfits"


def read_json_array_variant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON arrays whose cells may have mixed types, as ``schema`` (top-level
    columns) with ``_misfits``: the names of the cells, sorted, that hold a value
    which does not cast to the declared type.  Those cells are null.

    Each document is parsed once into a variant, its elements become rows, and
    every cell is cast by itself, so one odd cell costs neither its row nor its
    file.  A document that is no JSON array gives one row with only the misfit
    ``*``; elements that are no objects give a row with the misfit ``*`` too."""
    cols = schema_columns(schema)
    docs = (spark.read.option("wholetext", True).text(path)
            .select(F.try_parse_json("value").alias("doc")))
    bad = docs.where(F.coalesce(~F.schema_of_variant("doc").startswith("ARRAY"), F.lit(True)))
    good = docs.where(F.schema_of_variant("doc").startswith("ARRAY"))
    cells = spark.sql("SELECT e.value AS cell FROM {good}, LATERAL variant_explode(doc) AS e", good=good)
    get = lambda c, t: F.try_variant_get("cell", f"$['{c}']", t)
    odd = [F.when(get(c, t).isNull() & get(c, "variant").isNotNull() & ~F.is_variant_null(get(c, "variant")), F.lit(c))
           for c, t in sorted(cols)]
    is_object = F.schema_of_variant("cell").startswith("OBJECT")
    rows = cells.select(*[get(c, t).alias(c) for c, t in cols],
                        F.when(is_object, F.array_compact(F.array(*odd))).otherwise(F.array(F.lit("*"))).alias(MISFITS))
    none = bad.select(*[F.lit(None).cast(t).alias(c) for c, t in cols], F.array(F.lit("*")).alias(MISFITS))
    return rows.unionByName(none)


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if schema is None else df.select(*_names(schema))


def schema_columns(ddl: str) -> list[tuple[str, str]]:
    """'a string, b array<struct<x: bigint, y: double>>' -> [(a, string), (b, array<...>)]
    with types in Spark's compact form."""
    cols, depth, cur = [], 0, ""
    for ch in ddl + ",":
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            name, typ = cur.strip().split(" ", 1)
            cols.append((name, re.sub(r"\s*([:,])\s*", r"\1", typ.strip())))
            cur = ""
        else:
            cur += ch
    return cols


def _names(schema) -> list[str]:
    if isinstance(schema, StructType):
        return schema.fieldNames()
    return [name for name, _ in schema_columns(schema)]


def read_workbook(spark: SparkSession, path: str, schema=None) -> DataFrame:
    if schema is None:
        raise ValueError("spreadsheet sources need a declared schema (no type inference)")
    return read_xlsx(spark, path, schema)


READERS = {
    ".csv": read_csv,
    ".ndjson": read_ndjson,
    ".json": read_json_array,
    ".parquet": read_parquet,
    ".xlsx": read_workbook,
}


def reader_for(file_format: str, name: str = "?"):
    reader = READERS.get(file_format)
    if reader is None:
        raise ValueError(f"unsupported format {file_format} (source: {name})")
    return reader


def _strip_scheme(path: str) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def discover_sources(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Catalog of sources directly under ``raw_dir``:
    (name, format, path, n_files, bytes, modified), sorted by path.  ``name`` is the
    entry name without its suffix; the suffix match is case-sensitive;
    entries with other suffixes, and folders without a suffix, are ignored."""
    base = _strip_scheme(raw_dir)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(raw_dir).select("path", "length", "modificationTime"))
    entry = F.regexp_extract("path", re.escape(base) + r"/([^/]+)", 1)
    suffix = F.regexp_extract(entry, r"(\.[^.]+)$", 1)
    known = list(READERS)
    return (files.withColumn("entry", entry).withColumn("format", suffix)
                 .filter(F.col("format").isin(*known))
                 .groupBy("entry", "format")
                 .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"),
                      F.max("modificationTime").alias("modified"))
                 .select(F.expr("substring(entry, 1, length(entry) - length(format))").alias("name"),
                         "format",
                         F.concat(F.lit(raw_dir.rstrip("/") + "/"), F.col("entry")).alias("path"),
                         "n_files", "bytes", "modified")
                 .orderBy("path"))
