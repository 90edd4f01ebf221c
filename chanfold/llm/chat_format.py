"""Chat formatting by prefix-target expansion (DataFrame functions only).

Template.  A turn becomes ``<s>[HEADER] text </s>``.  The header is ``INST``
for a user turn, ``/INST`` for an assistant turn, ``SYS`` for a system turn
and ``ROLE:`` plus the role in base64 for any other role.  Inside texts each of
the characters ``\\ [ ] <`` is preceded by ``\\``, so no control string can
appear there and removing one backslash before each of them gives the text
back.

Expansion.  Every assistant turn becomes one example, written out in full by
``expand``: all preceding turns of its conversation, formatted, are the prefix,
the formatted reply is the target, and the loss mask is the one interval
``[loss_start, loss_end)``, the reply's text.  The examples of a conversation of
n turns hold about n*n/2 turns; that is the nature of the expansion.  They are
made one row at a time and need not be stored: ``segments`` has each formatted
turn once.

Defined cases: null text is empty; a null role is the empty role; turns of a
conversation are ordered by turn (nulls first), then role, then text; repeated
rows are separate turns; null conversation ids form one conversation;
conversations without an assistant turn have segments but no example; other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEADERS = {"user": "INST", "assistant": "/INST", "system": "SYS"}
OPEN, CLOSE = "<s>[", " </s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\\[\]<])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\\[\]<])", "$1")


def _header(role: Column) -> Column:
    out = F.concat(F.lit("ROLE:"), F.regexp_replace(F.base64(F.encode(role, "UTF-8")), r"\s", ""))
    for name, text in HEADERS.items():
        out = F.when(role == name, F.lit(text)).otherwise(out)
    return out


def _role(header: Column) -> Column:
    out = F.decode(F.unbase64(F.substr(header, F.lit(6))), "UTF-8")
    for name, text in HEADERS.items():
        out = F.when(header == text, F.lit(name)).otherwise(out)
    return out


def segments(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
             role: str = "role", text: str = "text") -> DataFrame:
    """One formatted turn per row: conv_id, seg (from 0), segment, is_target,
    seg_start (characters before it in the conversation), seg_chars,
    body_start and body_chars (the escaped text inside the segment)."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = (rows.withColumn("head", F.concat(F.lit(OPEN), _header(F.col("role")), F.lit("] ")))
            .withColumn("body", escape(F.col("text")))
            .withColumn("seg_chars", (F.char_length("head") + F.char_length("body")
                                      + F.lit(len(CLOSE))).cast("long")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("seg"),
        F.concat("head", "body", F.lit(CLOSE)).alias("segment"),
        (F.col("role") == "assistant").alias("is_target"),
        F.coalesce(F.sum("seg_chars").over(before), F.lit(0)).alias("seg_start"),
        "seg_chars",
        F.char_length("head").cast("long").alias("body_start"),
        F.char_length("body").cast("long").alias("body_chars"))


def _with_examples(segs: DataFrame) -> DataFrame:
    """Segments, those of assistant turns with their example: formatted (prefix
    and target in full; null for other turns), loss_start and loss_end."""
    upto = (Window.partitionBy("conv_id").orderBy("seg")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.col("seg_start") + F.col("body_start")
    return (segs.withColumn("parts", F.collect_list("segment").over(upto))
            .withColumn("formatted", F.when(F.col("is_target"), F.array_join("parts", "")))
            .withColumn("loss_start", start).withColumn("loss_end", start + F.col("body_chars")).drop("parts"))


def expand(segs: DataFrame) -> DataFrame:
    """One example per assistant turn: conv_id, seg (of the target),
    context_turns, context_chars (of the prefix), chars (of the whole example),
    loss_start, loss_end, target (the formatted reply) and formatted (prefix
    and target in full)."""
    return _with_examples(segs).where("is_target").select(
        "conv_id", "seg", F.col("seg").alias("context_turns"), F.col("seg_start").alias("context_chars"),
        (F.col("seg_start") + F.col("seg_chars")).alias("chars"), "loss_start", "loss_end",
        F.col("segment").alias("target"), "formatted")


def materialize(segs: DataFrame) -> DataFrame:
    """Examples for training alone: conv_id, seg, formatted, loss_start, loss_end."""
    return expand(segs).select("conv_id", "seg", "formatted", "loss_start", "loss_end")


def parse(segment: Column) -> tuple[Column, Column]:
    """Role and text of one formatted turn, read from the string alone."""
    inner = F.substr(segment, F.lit(len(OPEN) + 1),
                     F.char_length(segment) - F.lit(len(OPEN) + len(CLOSE)))
    header = F.substring_index(inner, "] ", 1)
    body = F.substr(inner, F.char_length(header) + F.lit(3))
    return _role(header), unescape(body)


def digest(segs: DataFrame) -> DataFrame:
    """Per conversation, the turns read back from the formatted strings and the
    replies read back from the full examples by their loss masks: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (of all its
    segments) and n_examples.

    A SHA-256 runs over one string, so here (and only here) the turns of one
    conversation meet in one value."""
    role, text = parse(F.col("segment"))
    # What the loss mask of an example covers.
    reply = unescape(F.substr(F.col("formatted"), (F.col("loss_start") + 1).cast("int"),
                              (F.col("loss_end") - F.col("loss_start")).cast("int")))
    both = _with_examples(segs).select("conv_id", "seg", F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("line"),
                                       reply.alias("reply"), "seg_chars")
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(F.col(c).isNotNull(), F.struct("seg", c)))), lambda x: x[c]), "")
    grouped = both.groupBy("conv_id").agg(
        F.count("line").alias("n_turns"), joined("line").alias("lines"),
        joined("reply").alias("replies"), F.sum("seg_chars").alias("formatted_chars"),
        F.count("reply").alias("n_examples"))
    return grouped.select(
        "conv_id", "n_turns", F.sha2(F.encode("lines", "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("replies").cast("long").alias("loss_chars"),
        F.sha2(F.encode("replies", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
