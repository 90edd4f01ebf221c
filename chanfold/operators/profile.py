"""Profiling: null counts, value counts, distinct values, summary statistics,
source profiles, ID overlap and code-dictionary inference.

All results are DataFrames in long form.  The only values that reach the
driver are the per-partition row counts of the exact quantile selection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from chanfold.session import work_dir


def _long(row_df: DataFrame, name_col: str, value_col: str) -> DataFrame:
    return row_df.unpivot([], row_df.columns, name_col, value_col)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column, in one pass."""
    columns = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(wide, "column_name", "null_count")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency per value (null included as its own value)."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) with every value cast to text: an unpivot."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (column_name, value) pairs; sort downstream if needed."""
    return _as_text(df, columns).distinct()


def profile_distinct(df: DataFrame, columns: list[str], n: int = 15) -> DataFrame:
    """Per column: number of distinct values (null counts as one) and the
    ``n`` smallest values as examples (nulls first).  Absent columns are
    skipped.  The top-n uses ``row_number() <= n``, which Spark executes with
    a partial per-partition limit before the shuffle, so a high-cardinality
    column never lands whole on one task."""
    columns = [c for c in columns if c in df.columns]
    pairs = distinct_values(df, columns)
    counts = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    w = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_first())
    top = (pairs.withColumn("value_rank", F.row_number().over(w))
                .filter(F.col("value_rank") <= n))
    # ``counts`` has one row per profiled column: bounded by the column list.
    return top.join(F.broadcast(counts), "column_name")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exact summary statistics per numeric column -- count, null count,
    mean, sample std, min, max -- computed in ONE aggregation pass (all
    partial-aggregatable), reshaped to one row per column."""
    columns = columns or numeric_columns(df)
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}_count"), F.count_if(x.isNull()).alias(f"c{i}_nulls"),
                 F.avg(x).alias(f"c{i}_mean"), F.stddev_samp(x).alias(f"c{i}_std"),
                 F.min(x).alias(f"c{i}_min"), F.max(x).alias(f"c{i}_max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"c{i}_count").alias("count"), F.col(f"c{i}_nulls").alias("null_count"),
                     F.col(f"c{i}_mean").alias("mean"), F.col(f"c{i}_std").alias("std"),
                     F.col(f"c{i}_min").alias("min"), F.col(f"c{i}_max").alias("max"))
            for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def describe_quantiles(df: DataFrame, columns: list[str] | None = None,
                       probabilities=(0.25, 0.5, 0.75), accuracy: int = 10_000) -> DataFrame:
    """Quartiles per numeric column with a bounded-memory sketch
    (``percentile_approx``: rank error at most 1/accuracy of the count), one
    pass.  ``exact_quantiles`` gives exact values at the price of a sort."""
    columns = columns or numeric_columns(df)
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"q{i}")
                    for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     *[F.col(f"q{i}")[j].alias(f"p{int(p * 100)}") for j, p in enumerate(probabilities)])
            for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def profile_source(df: DataFrame, source: str) -> DataFrame:
    """(source, position, column_name, data_type, n_rows, null_count) in one
    pass; the schema part comes from the plan, not from a job."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"n{i}").alias("null_count"))
            for i, f in enumerate(df.schema.fields)]
    return wide.select(F.lit(source).alias("source"), F.col("__rows").alias("n_rows"),
                       F.inline(F.array(*rows)))


def id_overlap(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Size of the intersection of the two distinct key sets (compared as
    text; null counts as a value, as in a set intersection)."""
    a = left.select(F.col(left_col).cast("string").alias("a")).distinct()
    b = right.select(F.col(right_col).cast("string").alias("b")).distinct()
    return a.join(b, F.col("a").eqNullSafe(F.col("b"))).agg(F.count(F.lit(1)).alias("overlap"))


def category_crosstab(coded: DataFrame, code_col: str, coded_key: str,
                      labelled: DataFrame, label_col: str, labelled_key: str) -> DataFrame:
    """Count of rows per (code, label) after joining the coded source to the
    labelled source on a shared product id.

    The coded side is pre-aggregated to (code, key, count) before the join
    and the labelled side reduced to distinct (key, label): the join then
    carries one row per distinct product instead of one per order line, so a
    hot product cannot overload one task."""
    return crosstab_of(code_counts(coded, code_col, coded_key), key_labels(labelled, label_col, labelled_key))


def code_counts(coded: DataFrame, code_col: str, coded_key: str) -> DataFrame:
    """(code, key, n): rows per code and product."""
    return (coded.groupBy(F.col(code_col).alias("code"), F.col(coded_key).cast("bigint").alias("key"))
                 .agg(F.count(F.lit(1)).alias("n")))


def key_labels(labelled: DataFrame, label_col: str, labelled_key: str) -> DataFrame:
    """Distinct (key, label) of a labelled source."""
    return labelled.select(F.col(labelled_key).cast("bigint").alias("key"), F.col(label_col).alias("label")).distinct()


def crosstab_of(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Crosstab of ``code_counts`` and ``key_labels``; stored in buckets of their
    key, the two meet without an exchange."""
    return (counts.join(labels, "key", "inner")
            .groupBy("code", "label").agg(F.sum("n").alias("count"))
            .orderBy(F.col("code").asc(), F.col("count").desc()))


def infer_code_mapping(crosstab: DataFrame) -> DataFrame:
    """Per code: the label seen most often (of equals the last in text order;
    a null label only if there is no other), its share of the code's matches
    (1.0 = fully consistent) and the number of matched rows."""
    return (crosstab.groupBy("code")
            .agg(F.max_by("label", F.struct("count", "label")).alias("inferred_label"),
                 (F.max("count") / F.sum("count")).alias("share"),
                 F.sum("count").alias("n_matched")))


def sample_rows(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows under a total order (deterministic head).  Planned as
    a per-partition top-n followed by a merge of at most n rows per task."""
    order_by = order_by or df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def exact_quantiles(spark, df: DataFrame, columns: list[str], probabilities=(0.25, 0.5, 0.75),
                    name: str = "quantiles", method: str = "disc", accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles without sorting whole columns or holding one in a task.

    ``method``: ``disc`` is SQL's ``percentile_disc``, the value of rank
    ceil(p * n) of the n values that are not null; ``nearest`` is the value of
    rank round(p * (n - 1)) + 1.

    A sketch first gives two values around each wanted rank.  One pass counts
    the values below the lower one, and only the values between the two, a few
    of every ``accuracy`` rows, are sorted: range-partitioned, with a random
    tie-breaker so that a value that fills much of a column is split over tasks,
    and written once with their positions.  One count per partition reaches the
    driver, and the wanted values are fetched by position.  Where the sketch
    missed (its error is a bound on average size only), the column is sorted
    whole.  Output: (column_name, p<percent>...)."""
    import math
    import uuid
    from fractions import Fraction

    x = {c: F.col(c).cast("double") for c in columns}
    spread = Fraction(2, accuracy)
    around = [float(min(max(Fraction(p) + side, 0), 1)) for p in probabilities for side in (-spread, spread)]
    seen = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(columns)],
                  *[F.percentile_approx(x[c], F.array(*map(F.lit, around)), accuracy).alias(f"q{i}")
                    for i, c in enumerate(columns)]).first()
    want = {}                                       # (column, p) -> rank, lower and upper value
    for i, c in enumerate(columns):
        n = seen[f"n{i}"]
        for j, p in enumerate(probabilities):
            if n:
                rank = (max(1, math.ceil(Fraction(p) * n)) if method == "disc"
                        else math.floor(Fraction(p) * (n - 1) + Fraction(1, 2)) + 1)
                want[c, p] = rank, seen[f"q{i}"][2 * j], seen[f"q{i}"][2 * j + 1]
    keys = list(want)
    if keys:
        parts = [F.count_if(x[c] < F.lit(want[c, p][1])).alias(f"b{k}") for k, (c, p) in enumerate(keys)]
        parts += [F.count_if(x[c].between(want[c, p][1], want[c, p][2])).alias(f"m{k}")
                  for k, (c, p) in enumerate(keys)]
        sizes = df.agg(*parts).first()
        rank_in = {}
        for k, key in enumerate(keys):
            rank_in[k] = want[key][0] - sizes[f"b{k}"]
            if not 1 <= rank_in[k] <= sizes[f"m{k}"]:
                rank_in[k] = want[key][0]
                want[key] = want[key][0], float("-inf"), float("nan")      # NaN is the largest double
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("k"), F.when(x[c].between(want[c, p][1], want[c, p][2]), x[c]).alias("v"))
            for k, (c, p) in enumerate(keys)]))).where(F.col("v").isNotNull())
        path = f"{work_dir(spark)}/chanfold-tmp/{name}-{uuid.uuid4().hex}"
        try:
            (pairs.orderBy("k", "v", F.rand(17))
             .select("k", "v", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("pos"))
             .write.parquet(path))
            ranked = spark.read.parquet(path)
            runs = sorted(tuple(r) for r in ranked.groupBy("k", "pid").agg(
                F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")).collect())
            at = {}
            for k in rank_in:
                before = 0
                for _, _, n, first in (r for r in runs if r[0] == k):
                    if before < rank_in[k] <= before + n:
                        at[k] = first + rank_in[k] - before - 1
                    before += n
            value = {r["pos"]: r["v"] for r in
                     ranked.where(F.col("pos").isin(list(at.values()))).select("pos", "v").collect()}
        finally:
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
        found = {keys[k]: value[pos] for k, pos in at.items()}
    else:
        found = {}
    rows = [(c, *[found.get((c, p)) for p in probabilities]) for c in columns]
    return spark.createDataFrame(
        rows, "column_name string, " + ", ".join(f"p{int(round(p * 100))} double" for p in probabilities))


def describe_all(spark, df: DataFrame) -> DataFrame:
    """Summary of every column in one table: column_name, count, null_count,
    mean, std, min, p25, p50, p75, max (of numbers, quartiles by nearest rank)
    and min_text, max_text (of all other columns)."""
    numeric = numeric_columns(df)
    other = [c for c in df.columns if c not in numeric]
    numbers = describe_numeric(df, numeric).join(
        F.broadcast(exact_quantiles(spark, df, numeric, method="nearest")), "column_name")
    wide = df.agg(*[a for i, c in enumerate(other) for a in (
        F.count(c).alias(f"n{i}"), F.count_if(F.col(c).isNull()).alias(f"z{i}"),
        F.min(F.col(c).cast("string")).alias(f"lo{i}"), F.max(F.col(c).cast("string")).alias(f"hi{i}"))])
    texts = wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"z{i}").alias("null_count"),
        F.col(f"lo{i}").alias("min_text"), F.col(f"hi{i}").alias("max_text")) for i, c in enumerate(other)])))
    return numbers.unionByName(texts, allowMissingColumns=True)


#: Values up to which a theta sketch of ``2 ** SKETCH_BITS`` entries holds every
#: hash, so that an empty intersection of two of them is certain.
SKETCH_BITS = 16


def id_sketches(frames: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(id, source, column_name, n_distinct, sketch): a theta sketch of every id
    column of ``frames`` (source -> table and columns), of constant size and
    mergeable, so it can be stored beside the source.  Null is a value (a text
    that is not empty, as sketches leave empty texts out)."""
    parts = []
    names = [(s, c) for s, (_, cols) in frames.items() for c in cols]
    for source, (df, cols) in frames.items():
        values = df.select(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")).alias(c) for c in cols])
        wide = values.agg(*[F.theta_sketch_agg(c, SKETCH_BITS).alias(c) for c in cols])
        rows = [F.struct(F.lit(names.index((source, c))).alias("id"), F.lit(source).alias("source"),
                         F.lit(c).alias("column_name"), F.col(c).alias("sketch")) for c in cols]
        parts.append(wide.select(F.inline(F.array(*rows))))
    return union_all(parts).select("id", "source", "column_name",
                                   F.theta_sketch_estimate("sketch").alias("n_distinct"), "sketch")


def id_overlaps(frames: dict[str, tuple[DataFrame, list[str]]], sketches: DataFrame) -> DataFrame:
    """(left_source, left_column, right_source, right_column, overlap) for every
    pair of id columns of different sources: the number of distinct values,
    compared as text and null included, that both hold.

    ``sketches`` (written ``id_sketches``) rule pairs out whose sketches are
    whole and share no hash.  The columns left are counted exactly in one
    aggregation: every value gets the set of columns that hold it, as bits, and
    the few sets are counted."""
    names = [(s, c) for s, (_, cols) in frames.items() for c in cols]
    if len(names) > 62:
        raise ValueError("at most 62 id columns are compared at once")
    pair = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if names[i][0] != names[j][0]]
    by_id = {r["id"]: r for r in sketches.select("id", "n_distinct").collect()}     # a row per column
    whole = {i for i in by_id if by_id[i]["n_distinct"] <= 1 << SKETCH_BITS}
    wide = sketches.groupBy().pivot("id", list(by_id)).agg(F.first("sketch"))
    shares = wide.select(*[F.theta_sketch_estimate(F.theta_intersection(F.col(f"`{i}`"), F.col(f"`{j}`"))).alias(f"{i}_{j}")
                           for i, j in pair]).first() if pair else {}
    left = [(i, j) for i, j in pair if shares[f"{i}_{j}"] > 0 or not {i, j} <= whole]
    wanted = {k for p in left for k in p}
    values = [df.select(F.inline(F.array(*[F.struct(F.col(c).cast("string").alias("value"),
                                                    F.lit(1 << names.index((s, c))).cast("bigint").alias("bit"))
                                           for c in cols if names.index((s, c)) in wanted])))
              for s, (df, cols) in frames.items() if any(names.index((s, c)) in wanted for c in cols)]
    spark = sketches.sparkSession
    listed = spark.createDataFrame([(*names[i], *names[j], (1 << i) | (1 << j)) for i, j in pair],
                                   "left_source string, left_column string, right_source string, right_column string, "
                                   "bits bigint")
    if not values:
        return listed.select("left_source", "left_column", "right_source", "right_column",
                             F.lit(0).cast("bigint").alias("overlap"))
    sets = union_all(values).groupBy("value").agg(F.bit_or("bit").alias("held")).groupBy("held").agg(
        F.count(F.lit(1)).alias("n"))
    masks = F.array(*[F.lit((1 << i) | (1 << j)).cast("bigint") for i, j in left])
    counts = (sets.select("n", F.explode(F.filter(masks, lambda m: F.col("held").bitwiseAND(m) == m)).alias("bits"))
              .groupBy("bits").agg(F.sum("n").alias("n")))
    return listed.join(counts, "bits", "left").select(
        "left_source", "left_column", "right_source", "right_column", F.coalesce("n", F.lit(0)).alias("overlap"))


#: Size parameter of the quantile sketches and the rank error it keeps within.
KLL_K, KLL_ERROR = 400, 0.02


def quantile_cells(df: DataFrame, dims: list[str], columns: list[str], k: int = KLL_K) -> DataFrame:
    """(dims, column_name, sketch): a KLL sketch of each numeric column in each
    cell, of bounded size; null values and cells without any are left out."""
    cols = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns]
    return (df.select(*dims, F.inline(F.array(*cols))).where(F.col("x").isNotNull() & ~F.isnan("x"))
            .groupBy(*dims, "column_name").agg(F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch")))


def quantiles_of_cut(cells: DataFrame, by: list[str], probabilities=(0.25, 0.5, 0.75)) -> DataFrame:
    """(by, column_name, p, n, value): quantiles of any cut of stored cells, from
    their merged sketches."""
    merged = cells.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    rows = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
            for p in probabilities]
    return merged.select(*by, "column_name", F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(F.array(*rows)))


def checked_quantiles(df: DataFrame, quantiles: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``quantiles`` with ``rank_error``: how far, as a share of the values, the
    wanted rank is from the ranks that the value has in ``df``.

    One pass counts the values below and up to each quantile of their group; the
    quantiles, a few rows a group, are joined as one row per group and column."""
    cols = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns]
    values = df.select(*by, F.inline(F.array(*cols))).where(F.col("x").isNotNull() & ~F.isnan("x"))
    wide = (quantiles.withColumnsRenamed({c: f"_{c}" for c in [*by, "column_name"]})
            .groupBy(*[f"_{c}" for c in [*by, "column_name"]])
            .agg(F.array_sort(F.collect_list(F.struct("p", "value", "n"))).alias("own")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "column_name"]])
    n_p = quantiles.select("p").distinct().count()
    ranks = values.join(wide, same).groupBy(*by, "column_name", "own").agg(
        *[F.count_if(F.col("x") < F.col("own")[i]["value"]).alias(f"below{i}") for i in range(n_p)],
        *[F.count_if(F.col("x") <= F.col("own")[i]["value"]).alias(f"upto{i}") for i in range(n_p)])
    rows = []
    for i in range(n_p):
        q = F.col("own")[i]
        want = q["p"] * q["n"]
        error = F.greatest(F.col(f"below{i}") - want, want - F.col(f"upto{i}"), F.lit(0.0)) / q["n"]
        rows.append(F.struct(q["p"].alias("p"), q["n"].alias("n"), q["value"].alias("value"), error.alias("rank_error")))
    return ranks.select(*by, "column_name", F.inline(F.array(*rows)))


#: Items that a frequent-item sketch of one column tracks (64-bit hashes, so a
#: sketch takes a few megabytes whatever the values are), and how many of them
#: are counted exactly.
TRACKED, CANDIDATES = 16_384, 256


def _texts(columns: list[str], keep) -> F.Column:
    """(column_name, value) structs of a row for which ``keep(i, value)`` is true."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"),
                               keep(i, F.col(f"`{c}`").cast("string")).alias("keep")) for i, c in enumerate(columns)])
    return F.inline(F.filter(cells, lambda x: x["keep"]))


def frequent_counts(df: DataFrame, columns: list[str], n: int = 15, tracked: int = TRACKED,
                    candidates: int = CANDIDATES) -> tuple[DataFrame, list[str]]:
    """((column_name, value, n), columns left open): exact counts of the values
    that a frequent-item sketch names, and the columns in which another value
    could still be among the ``n`` most frequent.

    The first pass makes one mergeable sketch per column, over hashes of the
    values; at most ``candidates`` hashes a column reach the driver.  The second
    counts the values with these hashes, so nothing else is shuffled.

    A value that the sketch does not name has at most 6 * rows / ``tracked``
    rows (twice the sketch's error), or as many as the last one named if the list
    is full; and never more than the rows that no candidate covers.  A column is
    decided if its n-th count is above that."""
    if not columns:
        raise ValueError("no columns to count")
    seen = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.expr(f"approx_top_k(xxhash64(cast(`{c}` as string)), {candidates}, {tracked})").alias(f"k{i}")
        for i, c in enumerate(columns)]).first()
    named = [[x["item"] for x in seen[f"k{i}"]] for i in range(len(columns))]
    bound = [max(6 * seen["rows"] / tracked, top[-1]["count"] if len(top) >= candidates else 0)
             for top in (seen[f"k{i}"] for i in range(len(columns)))]
    hits = df.select(_texts(columns, lambda i, v: F.xxhash64(v).isin(named[i]) if named[i] else F.lit(False)))
    work_dir(df.sparkSession)                          # names the checkpoint folder where none is set
    counts = hits.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    per = {r["column_name"]: r for r in counts.groupBy("column_name").agg(
        F.sum("n").alias("covered"), F.slice(F.sort_array(F.collect_list("n"), False), n, 1).alias("last")).collect()}
    left = []
    for i, c in enumerate(columns):
        rest = seen["rows"] - (per[c]["covered"] if c in per else 0)
        last = per[c]["last"][0] if c in per and per[c]["last"] else 0
        if rest and last <= min(rest, bound[i]):
            left.append(c)
    return counts, left


def frequent_values(df: DataFrame, columns: list[str], n: int = 15, tracked: int = TRACKED,
                    candidates: int = CANDIDATES) -> DataFrame:
    """(column_name, value, value_rank, n): the ``n`` most frequent values of each
    column, as text, null being one, with exact counts; of equal counts the
    smaller value (null first) comes first.

    Only columns that the sketches leave open (``frequent_counts``), those with no
    values that stand out, are counted whole, combined before their shuffle.  An
    empty table gives no rows."""
    counts, left = frequent_counts(df, columns, n, tracked, candidates)
    if left:
        whole = (df.select(_texts(left, lambda i, v: F.lit(True))).groupBy("column_name", "value")
                 .agg(F.count(F.lit(1)).alias("n")))
        counts = counts.where(~F.col("column_name").isin(left)).unionByName(whole)
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return (counts.withColumn("value_rank", F.row_number().over(w).cast("bigint")).where(F.col("value_rank") <= n)
            .select("column_name", "value", "value_rank", "n"))
