"""Best-fit packing of token runs by bin completion.

Lengths are whole numbers up to the capacity, so a corpus of any size has at
most ``capacity`` distinct lengths.  The search runs over that histogram: its
answer is a list of fillings with multiplicities, which Spark spreads over the
pieces by their rank within their length.

Search (``solve``): take the largest length left, enumerate the undominated
fillings of the rest of its bin, best filled first, use a filling as often as
the counts allow (then fewer times: half as often down to eight, then one by one
less), and go on with what is left.  A branch is given up once its waste exceeds
what a solution one bin better than the incumbent could waste.  The first
incumbent is best fit decreasing; the search ends at the lower bound
(``lower_bound``) or after ``max_nodes`` nodes, and then keeps the
best incumbent.  No other bound cuts it short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanfold.llm import common
from chanfold.llm.tokens import documents_ids, library_encoder

Filling = tuple[tuple[int, int], ...]        # (length, copies), longest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any solution needs.  For each ``small``: items above
    ``capacity - small`` stand alone, no two above half share a bin, and items
    from ``small`` up to half must go to the room beside those or to more bins."""
    best = -(-sum(s * c for s, c in counts.items()) // capacity)
    for small in {s for s in counts if 2 * s <= capacity}:
        alone = sum(c for s, c in counts.items() if s > capacity - small)
        large = {s: c for s, c in counts.items() if 2 * s > capacity and s <= capacity - small}
        room = sum((capacity - s) * c for s, c in large.items())
        rest = sum(s * c for s, c in counts.items() if small <= s and 2 * s <= capacity)
        best = max(best, alone + sum(large.values()) + max(0, -(-(rest - room) // capacity)))
    return max(best, sum(c for s, c in counts.items() if 2 * s > capacity))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best fit decreasing over the histogram; equal bins move together."""
    open_bins: dict[int, dict[Filling, int]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_bins if r >= size), default=None)
            if room is None:
                each = capacity // size
                for copies, bins in ((each, left // each), (left % each, 1)):
                    if copies and bins:
                        own = open_bins.setdefault(capacity - copies * size, {})
                        key = ((size, copies),)
                        own[key] = own.get(key, 0) + bins
                break
            filling, bins = next(iter(open_bins[room].items()))
            each = min(room // size, left)
            used = min(bins, left // each)
            if used == bins:
                del open_bins[room][filling]
                if not open_bins[room]:
                    del open_bins[room]
            else:
                open_bins[room][filling] = bins - used
            own = open_bins.setdefault(room - each * size, {})
            key = filling + ((size, each),)
            own[key] = own.get(key, 0) + used
            left -= used * each
    return [(f, n) for own in open_bins.values() for f, n in own.items()]


def _dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """The items of ``b`` can be put into bins as large as the items of ``a``."""
    def fits(items, rooms):
        if not items:
            return True
        for i in sorted({r: i for i, r in enumerate(rooms) if r >= items[0]}.values()):
            if fits(items[1:], rooms[:i] + (rooms[i] - items[0],) + rooms[i + 1:]):
                return True
        return False
    return sum(b) <= sum(a) and fits(b, a)


def fillings(counts: dict[int, int], room: int, waste: int) -> Iterator[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with lengths of ``counts`` leaving at
    most ``waste`` empty, best filled first, larger lengths first among equals.

    The sums that the smaller lengths can make are kept as bits of whole
    numbers, so the walk to a sum takes no step that does not lead there."""
    sizes = [s for s in sorted(counts, reverse=True) if s <= room and counts[s]]
    reach = [1] * (len(sizes) + 1)                       # of sizes[i:]
    for i in range(len(sizes) - 1, -1, -1):
        sums, left, step = reach[i + 1], min(counts[sizes[i]], room // sizes[i]), 1
        while left:
            step = min(step, left)
            sums |= sums << sizes[i] * step
            left -= step
            step *= 2
        reach[i] = sums & (1 << room + 1) - 1

    def walk(at: int, total: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
        for i in range(at, len(sizes) if total else 0):
            if not reach[i] >> total & 1:
                return
            s = sizes[i]
            for copies in range(min(counts[s], total // s), 0, -1):
                if reach[i + 1] >> total - copies * s & 1:
                    for rest in walk(i + 1, total - copies * s):
                        yield (s,) * copies + rest

    seen: list[tuple[int, ...]] = []
    for total in range(room, max(room - waste, 0) - 1, -1):
        if reach[0] >> total & 1:
            for f in walk(0, total):
                if not any(_dominates(k, f) for k in seen):
                    seen.append(f)
                    yield f


def _choices(left: dict[int, int], capacity: int, allowed: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Fillings around the largest length left, each with how often to use it:
    as often as the counts and the waste allow, then fewer times."""
    top = max(left)
    rest = {s: c - (s == top) for s, c in left.items()}
    for f in fillings(rest, capacity - top, min(allowed, capacity)):
        items = (top, *f)
        times, waste = min(left[s] // items.count(s) for s in set(items)), capacity - sum(items)
        if waste:
            times = min(times, allowed // waste)
        while times:
            yield items, times
            times = times // 2 if times > 8 else times - 1


def solve(counts: dict[int, int], capacity: int, max_nodes: int = 6000) -> list[tuple[Filling, int]]:
    """Fillings with multiplicities that hold every item once."""
    counts = {int(s): int(c) for s, c in counts.items() if c}
    best = best_fit(counts, capacity)
    bound, total = lower_bound(counts, capacity), sum(s * c for s, c in counts.items())
    n_best = sum(n for _, n in best)
    nodes = 0
    # A node: counts left, waste spent so far, choices not yet tried; path: what was used.
    spare = lambda: (n_best - 1) * capacity - total      # noqa: E731  waste of a solution one bin better
    stack = [(dict(counts), 0, _choices(counts, capacity, spare()))] if n_best > bound else []
    path: list[tuple[tuple[int, ...], int]] = []
    while stack and n_best > bound and nodes < max_nodes:
        left, spent, untried = stack[-1]
        items, times = next(untried, ((), 0))
        waste = (capacity - sum(items)) * times
        if not times or spent + waste > spare():
            if not times or waste == 0 or times == 1:    # later choices waste no less
                stack.pop()
                if path:
                    path.pop()
            continue
        nodes += 1
        rest = dict(left)
        for s in set(items):
            rest[s] -= items.count(s) * times
            if not rest[s]:
                del rest[s]
        path.append((items, times))
        if rest:
            stack.append((rest, spent + waste, _choices(rest, capacity, spare() - spent - waste)))
            continue
        n_best = sum(n for _, n in path)
        best = [(tuple((s, f.count(s)) for s in sorted(set(f), reverse=True)), n) for f, n in path]
        path.pop()
    return best


def placements(solution: list[tuple[Filling, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, lo, hi, copies, first, offset): items of that length with
    ranks in [lo, hi) go, ``copies`` to a sequence, to sequence
    ``first + (rank - lo) // copies`` from ``offset`` on."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for filling, times in solution:
        offset = 0
        for size, copies in filling:
            lo = used.get(size, 0)
            used[size] = lo + copies * times
            rows.append((size, lo, used[size], copies, first, offset))
            offset += size * copies
        first += times
    return rows


def pack(pieces: DataFrame, capacity: int, length_col: str = "length",
         max_nodes: int = 6000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` added (columns of these
    names are replaced).

    Every piece of 1 to ``capacity`` ids gets a place; pieces of one sequence
    do not overlap and leave no gap before the last.  A null or zero length
    takes no place (both columns null); a longer piece is an error.  Only the
    histogram, at most ``capacity`` rows, reaches the driver."""
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    rid, part, rank = "__pack_rid", "__pack_part", "__pack_rank"
    rows = common.written(pieces.withColumn(rid, F.monotonically_increasing_id()), "pieces")
    rows = rows.withColumn(part, F.shiftright(rid, 33))
    size = F.col(length_col)
    per_part = rows.where((size > 0) & (size != capacity)).groupBy(part, size.alias("__pack_len")).count()
    per_part = common.written(per_part, "piece-counts")
    counts = {r[0]: r[1] for r in per_part.groupBy("__pack_len").agg(F.sum("count")).collect()}
    if counts and max(counts) > capacity:
        raise ValueError(f"a piece of {max(counts)} ids is longer than {capacity}")
    plan = placements(solve(counts, capacity, max_nodes))
    slots = F.broadcast(spark.createDataFrame(
        plan, "__pack_len long, __pack_lo long, __pack_hi long, __pack_copies long, "
              "__pack_first long, __pack_offset long"))
    before = Window.partitionBy("__pack_len").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select(part, "__pack_len",
                            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__pack_base"))
    own = Window.partitionBy(part, "__pack_len").orderBy(rid)
    alone = size == capacity
    ranked = (rows.withColumn("__pack_len", F.when((size > 0) & ~alone, size.cast("long")))
              .withColumn(rank, F.row_number().over(own) - 1))
    placed = (ranked.join(bases, [part, "__pack_len"], "left")
              .withColumn(rank, F.col(rank) + F.col("__pack_base"))
              .join(slots.withColumnRenamed("__pack_len", "__slot_len"),
                    (F.col("__pack_len") == F.col("__slot_len")) & (F.col(rank) >= F.col("__pack_lo"))
                    & (F.col(rank) < F.col("__pack_hi")), "left"))
    at = F.col(rank) - F.col("__pack_lo")
    return placed.select(
        *names,
        F.when(alone, -1 - F.col(rid)).otherwise(
            F.col("__pack_first") + F.floor(at / F.col("__pack_copies"))).cast("long").alias("sequence_id"),
        F.when(alone, F.lit(0)).otherwise(
            F.col("__pack_offset") + (at % F.col("__pack_copies")) * size).cast("long").alias("offset"))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of whole texts with ``end_id`` appended, cut into pieces of
    ``capacity`` (a shorter piece is the first): doc_id, piece, start, length,
    ids (little-endian unsigned 32-bit), ids_crc32.  Null text is empty."""
    common.python_tasks(docs.sparkSession)

    names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32"]

    def task(batches):
        encoder = library_encoder(tokenizer_path)
        for batch in batches:
            doc_ids, rows = batch.column("id").to_pylist(), []
            for doc_id, ids in zip(doc_ids, documents_ids(encoder, batch.column("text"), end_id)):
                data = ids.astype("<u4").tobytes()
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    own = data[4 * lo:4 * hi]
                    rows.append((doc_id, k, lo, hi - lo, own, zlib.crc32(own)))
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)
        del encoder
        common.release()

    def _batch(rows):
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(task, "doc_id long, piece int, start long, length long, ids binary, "
                                 "ids_crc32 long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (pieces in place)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.where(F.col("sequence_id").isNotNull()).groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids")))
