"""Quality rules with risk-controlled thresholds (DataFrame functions only).

A rule turns a document's measures into a number (``RULES``), and rejects the
document from some cutoff on.  The cutoffs that may be used are a fixed grid, so
every labelled document is holdout data.  For each stratum, rule and cutoff the
holdout documents of label 1 that pass the base rules are counted, and those of
them the cutoff would reject.  A cutoff is certified if its true share of false
rejections exceeds the allowed one with probability at most ``risk / m``: if
the exact binomial tail ``P(X <= rejected)`` for the allowed share is at most
that.  ``m`` is the number of strata times rules times cutoffs (Bonferroni), and
the allowed share is split over the rules, so with confidence ``1 - risk`` all
rules together reject at most ``allowed`` of the good documents in every
stratum.  The strictest certified cutoff of a rule holds; a rule without one
rejects nothing in that stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanfold.llm.common import written

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
ALLOWED, RISK = 0.05, 0.05
#: Thousandths, from the strictest cutoff to the loosest; a rule rejects values
#: from its cutoff on.
CUTOFFS = {
    "symbols": (5, 10, 20, 40, 80, 160, 320, 500),
    "repeats": (20, 40, 80, 120, 160, 200, 250, 290),
    "lines": (5, 10, 20, 40, 60, 80, 120, 160),
    "long_words": (5500, 6000, 6500, 7000, 8000, 10000, 14000, 20000),
    "short_words": (-4500, -4200, -4000, -3800, -3500, -3000, -2500, -2000),
}
#: Rows up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 500_000

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"


def rules() -> dict[str, Column]:
    """The value of each rule in thousandths, from the measures."""
    share = lambda a, b: F.floor(1000 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return {"symbols": share("n_symbols", "word_chars"), "repeats": share("n_repeat_words", "n_words"),
            "lines": share("n_dup_lines", "n_words"), "long_words": share("word_chars", "n_words"),
            "short_words": -share("word_chars", "n_words")}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum (null: empty string), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and base_failed of every row.  Null text has no
    words; other columns are ignored.

    Words in windows that occur again are found inside the row: windows are
    64-bit hashes of the words' hashes; where some hash repeats, the windows
    are sorted by hash, those with an equal neighbour are sorted by place, and
    each covers the words up to the next one, at most ``WINDOW``."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "stratum",
        F.char_length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(F.filter(F.split(text, _SPACE), lambda x: x != ""), lambda x: F.xxhash64(x)).alias("words"))
    n = F.size("words")
    rows = rows.select(
        "doc_id", "stratum", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
            *(F.get(F.col("words"), i + k) for k in range(WINDOW))))).alias("windows"))
    names = ["doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.select(*names, F.when(again, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("windows"))
    beside = lambda x, i, step: F.coalesce(F.get(F.col("windows"), i + step)["h"] == x["h"], F.lit(False))
    rows = rows.select(*names, F.sort_array(F.transform(
        F.filter("windows", lambda x, i: beside(x, i, -1) | beside(x, i, 1)), lambda x: x["i"])).alias("places"))
    covered = F.transform("places", lambda x, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("places"), i + 1) - x, F.lit(WINDOW))))
    rows = rows.select(*names, F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))
                       .cast("long").alias("n_repeat_words"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", base)


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1: Stirling's series at x + 8."""
    z = x + F.lit(8.0)
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7)
    down = sum((F.log(x + F.lit(float(k))) for k in range(8)), F.lit(0.0))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - down


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of n draws with probability p, for k < n * p; else 1.

    The largest term comes from the gamma function, and each further term is
    the one before times a ratio.  Terms more than twelve standard deviations
    below the mean add less than 1e-30 and end the sum."""
    x, top = k.cast("double"), n.cast("double")
    log_term = (_log_gamma(top + 1) - _log_gamma(x + 1) - _log_gamma(top - x + 1)
                + x * math.log(p) + (top - x) * math.log1p(-p))
    most = F.least(k, F.ceil(12 * F.sqrt(top * p)) + 50).cast("int")
    steps = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    ratio = lambda j: (x - j + 1) / (top - x + j) * ((1 - p) / p)
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
                        lambda a, j: F.struct((a["term"] * ratio(j)).alias("term"),
                                              (a["total"] + a["term"] * ratio(j)).alias("total")),
                        lambda a: a["total"])
    return F.when(x < top * p, F.exp(log_term) * total).otherwise(F.lit(1.0))


def certified(measured: DataFrame, labels: DataFrame, allowed: float = ALLOWED, risk: float = RISK,
              cutoffs: dict[str, tuple[int, ...]] | None = None, id_col: str = "doc_id",
              label_col: str = "quality") -> DataFrame:
    """stratum, rule, cutoff, n_good, n_rejected and tail of the strictest
    certified cutoffs.  Repeated labels of an id count once, and as good only
    if all are; null ids and labels are left out."""
    cutoffs = cutoffs or CUTOFFS
    good = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(F.col(label_col)).alias("good"))
            .where("good = 1").select("doc_id"))
    held = measured.where(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    own = rules()
    # One row per stratum with the counts of all cutoffs, then a row per cutoff.
    names = [(r, c) for r in sorted(cutoffs) for c in cutoffs[r]]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *(
        F.sum(F.when(own[r] >= c, 1).otherwise(0)).alias(f"{r}{i}") for i, (r, c) in enumerate(names)))
    p = allowed / len(cutoffs)
    strata = measured.select("stratum").distinct().count()
    level = risk / (max(1, strata) * len(names))
    tests = counts.select("stratum", "n_good", F.inline(F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}{i}").alias("n_rejected"))
        for i, (r, c) in enumerate(names)))))
    tests = tests.withColumn("tail", binomial_tail(F.col("n_good"), F.col("n_rejected"), p))
    return (tests.where(F.col("tail") <= level).groupBy("stratum", "rule")
            .agg(F.min(F.struct("cutoff", "n_good", "n_rejected", "tail")).alias("own"))
            .select("stratum", "rule", "own.*"))


def judge(docs: DataFrame, labels: DataFrame, allowed: float = ALLOWED, risk: float = RISK,
          cutoffs: dict[str, tuple[int, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """The measures of every row with ``failed_rules`` (names, sorted) and
    ``kept``: false if the row fails the base rules or a certified cutoff.

    Null text has no words and fails the base rules; null strata are one
    stratum, the empty string; null ids are judged but are no holdout; repeated
    rows are judged alike; without labels only the base rules count; an empty
    table gives no rows."""
    measured = written(measures(docs, id_col, text_col, stratum_col), "measures")
    held = certified(measured, labels, allowed, risk, cutoffs, id_col, label_col)
    held = written(held.groupBy("stratum").agg(*(
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cutoff_{r}") for r in CUTOFFS)), "cutoffs")
    side = F.broadcast(held) if held.count() <= BROADCAST_ROWS else held
    fails = [F.when(value >= F.col(f"cutoff_{r}"), F.lit(r)) for r, value in sorted(rules().items())]
    out = measured.join(side, "stratum", "left").withColumn("failed_rules", F.array_compact(F.array(*fails)))
    return out.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))
