"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and cut into halves.  Each half has a codebook
of its own (k-means on a bounded sample); a cell is a pair of codewords, one
from each, and a vector is stored in the cell of its two nearest codewords.
Every vector visits cells in ascending order of the summed distances to their
codewords (the multi-sequence order), up to a ``reach`` beyond the nearest cell,
and is compared with their members by exact cosine in double precision.

The reach is measured on links, of which either end may visit the other's cell.
It is the least that meets ``target`` of both (a) links of ``calibration`` vectors
to copies of them turned to the least cosine in random directions, the farthest
links there can be, whether or not the sample has any in the table, and (b) all
links of these vectors in the table, themselves left out.  So visits grow with
the number of cells.  Every row is indexed and every row visits.

Members and visitors of a cell meet as blocks, so a cell of any size is split
over tasks.  A pair of blocks yields its number of links per vector and a
spanning forest of the links instead of the links themselves: counts and
components stay exact, and the output does not grow with the square of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm.common import python_tasks, written
from chanfold.llm.components import components
from chanfold.llm.vectors import BLOCK, cells_to_blocks, cosines, matrix, sample, unit, usable

BLOCK_ROWS = 1024
#: Rows dealt to blocks at a time: of fewer, the blocks of a cell would be many
#: and small.
MEMBER_ROWS, VISIT_ROWS = 32_768, 4096
#: Cosines this close to the threshold are summed again by one fixed rule.
CLOSE = 1e-9
#: Turned copies of each calibration vector, and steps of the reach per unit.
TURNS, BINS = 16, 4096


@dataclass
class Index:
    left: np.ndarray                # codewords of the first half
    right: np.ndarray
    reach: float = 0.0              # beyond the nearest cell's distance
    floor: int = 1                  # cells visited at least

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _squared(x[:, :half], self.left), _squared(x[:, half:], self.right)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def nearest_cells(self, x: np.ndarray, most: int) -> np.ndarray:
        """The first ``most`` cells of each row in multi-sequence order.

        A pair of ranks (i, j) has (i + 1) * (j + 1) - 1 pairs before it, so
        only pairs with a product up to ``most`` can be among the first."""
        a, b = self.distances(x)
        ia, ib = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        i, j = np.meshgrid(np.arange(len(self.left)), np.arange(len(self.right)), indexing="ij")
        good = (i + 1) * (j + 1) <= most
        i, j = i[good], j[good]
        row = np.arange(len(x))[:, None]
        total = np.take_along_axis(a, ia, 1)[:, i] + np.take_along_axis(b, ib, 1)[:, j]
        order = np.argsort(total, axis=1, kind="stable")[:, :most]
        return ia[row, i[order]] * len(self.right) + ib[row, j[order]]

    def excess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(x)
        return a - a.min(axis=1, keepdims=True), b - b.min(axis=1, keepdims=True)

    def beyond(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How far each cell is beyond each row's nearest: rows x cells."""
        a, b = self.excess(x)
        return a[:, cells // len(self.right)] + b[:, cells % len(self.right)]

    def visited(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells that rows visit, as pairs of a row and a cell."""
        a, b = self.excess(x)
        row, left = np.nonzero(a <= self.reach)
        pair, right = np.nonzero(a[row, left][:, None] + b[row] <= self.reach)
        n = len(self.left) * len(self.right)
        near = self.nearest_cells(x, self.floor)
        keys = np.unique(np.concatenate([row[pair] * n + left[pair] * len(self.right) + right,
                                         (np.arange(len(x))[:, None] * n + near).ravel()]))
        return keys // n, keys % n

    def visits(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether each row visits each of the cells: rows x cells."""
        near = self.nearest_cells(x, self.floor)
        return (self.beyond(x, cells) <= self.reach) | np.array([np.isin(cells, c) for c in near])


def _squared(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)


def codebook(x: np.ndarray, size: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Codewords by k-means, started from distinct sampled rows."""
    x = np.unique(x, axis=0)
    words = x[np.random.default_rng(seed).permutation(len(x))[:size]]
    for _ in range(rounds):
        own = _squared(x, words).argmin(axis=1)
        for k in np.unique(own):
            words[k] = x[own == k].mean(axis=0)
    return words


def fit(x: np.ndarray, rows: int) -> Index:
    """Codebooks from sampled rows; more rows, more codewords, so that cells
    keep their size."""
    size = int(np.clip(round(np.sqrt(rows / 64)), 2, 256))
    half = max(1, x.shape[1] // 2)
    right = x[:, half:] if x.shape[1] > 1 else np.zeros((len(x), 1))
    return Index(codebook(x[:, :half], size), codebook(right, size))


def _padded(x: np.ndarray) -> np.ndarray:
    return x if x.shape[1] > 1 else np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def _links(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    near = a @ b.T
    out = near >= least
    i, j = np.nonzero(np.abs(near - least) < CLOSE)
    out[i, j] = cosines(a[i], b[j]) >= least
    return out


def _least_bin(bins: np.ndarray, counts: np.ndarray, target: float) -> float:
    """The upper bound of the first bin up to which ``target`` of the counts lie."""
    order = np.argsort(bins)
    total = np.cumsum(counts[order])
    return float(bins[order][np.searchsorted(total, target * total[-1])] / BINS)


def _turned(x: np.ndarray, least: float, seed: int) -> np.ndarray:
    """Each row turned in a random direction, to a cosine of ``least`` with itself."""
    z = np.random.default_rng(seed).normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-300)
    return least * x + np.sqrt(max(0.0, 1 - least * least)) * z


def _between(index: Index, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The reach with which links are met, for equal rows of x and y."""
    n = len(index.right)
    one, two = index.cells(x), index.cells(y)
    ax, bx = index.excess(x)
    ay, by = index.excess(y)
    row = np.arange(len(x))
    return np.minimum(ax[row, two // n] + bx[row, two % n], ay[row, one // n] + by[row, one % n])


def calibrate(index: Index, rows: DataFrame, least: float, calibration: int, target: float) -> float:
    """The reach that meets ``target`` of the links (see above)."""
    ids, x = sample(rows, calibration)
    flat = x.shape[1] < 2                   # nothing to turn to
    x = _padded(x)
    shared = rows.sparkSession.sparkContext.broadcast((ids, x))

    def task(frames):
        for frame in frames:
            own, own_ids = _padded(unit(matrix(frame["vector"]))), frame["id"].to_numpy(np.int64)
            asked_ids, asked = shared.value
            cells = index.cells(asked)
            for lo in range(0, len(own), BLOCK_ROWS):
                some, some_ids = own[lo:lo + BLOCK_ROWS], own_ids[lo:lo + BLOCK_ROWS]
                i, j = np.nonzero(_links(asked, some, least) & (asked_ids[:, None] != some_ids[None, :]))
                if len(i):
                    there = index.beyond(asked, index.cells(some))[i, j]
                    reach = np.minimum(there, index.beyond(some, cells)[j, i])
                    bins, counts = np.unique(np.ceil(reach * BINS).astype(np.int64), return_counts=True)
                    yield pd.DataFrame({"bin": bins, "links": counts})

    met = (rows.mapInPandas(task, "bin long, links long").groupBy("bin").agg(F.sum("links").alias("links"))
           .toPandas())
    reach = _least_bin(met["bin"].to_numpy(), met["links"].to_numpy(), target) if len(met) else 0.0
    if not flat:
        turned = np.concatenate([_between(index, x, _turned(x, least, seed)) for seed in range(TURNS)])
        reach = max(reach, float(np.quantile(turned, target, method="higher")))
    return reach


def _gathered(frames, most: int):
    """Consecutive frames put together, of at least ``most`` rows but the last."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= most:
            yield pd.concat(held)
            held, size = [], 0
    if size:
        yield pd.concat(held)


def _forest(linked: np.ndarray) -> np.ndarray:
    """A label for each row and then each column of a matrix of links: its
    component, as the smallest index in it."""
    n, m = linked.shape
    label = np.arange(n + m)
    rows, cols = np.nonzero(linked)
    while True:
        low = np.minimum(label[rows], label[n + cols])
        new = label.copy()
        np.minimum.at(new, rows, low)
        np.minimum.at(new, n + cols, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(rows: DataFrame, least: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding", max_sample: int = 8192, calibration: int = 256,
                    target: float = 0.995, floor: int = 4) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links (other rows linked
    directly), component_id (smallest vec_id reachable, itself included), kept
    (vec_id = component_id).

    Rows link when their cosine is at least ``least``.  Vectors that are null,
    empty, zero, of another length than most, or hold null, NaN or infinite
    components link with nothing; a null id gets a null component and is not
    kept.  Repeated ids are one vector to others, the one with the smallest
    hash, and each of their rows is returned.  An empty table gives no rows; other columns are ignored."""
    spark = rows.sparkSession
    python_tasks(spark)
    whole = rows.select(F.col(id_col).cast("long").alias("id"))
    own = usable(rows, id_col, vector_col)
    # Equal vectors are one node, named by the smallest id.
    members = written(own.join(own.groupBy("vector").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "vector"), "vectors")
    nodes = written(members.where("id = node").select("id", "vector", "copies"), "nodes")
    n = nodes.count()
    out = "id long, root long, links long"
    if n:
        ids, x = sample(nodes, max_sample)
        index = fit(_padded(x), n)
        index.floor = min(floor, len(index.left) * len(index.right))
        index.reach = calibrate(index, nodes, least, calibration, target)
        # Blocks hold the vectors as they came: floats take half the room of doubles.
        kind = "<f4" if dict(rows.dtypes)[vector_col] == "array<float>" else "<f8"

        def member_task(frames):
            for frame in _gathered(frames, MEMBER_ROWS):
                raw = matrix(frame["vector"])
                ids = frame[["id", "copies"]].to_numpy(np.int64)
                yield cells_to_blocks(index.cells(_padded(unit(raw))), ids, raw, BLOCK_ROWS, kind)

        def visit_task(frames):
            for frame in _gathered(frames, VISIT_ROWS):
                raw = matrix(frame["vector"])
                ids = frame[["id", "copies"]].to_numpy(np.int64)
                for lo in range(0, len(ids), VISIT_ROWS):
                    some = slice(lo, lo + VISIT_ROWS)
                    row, cells = index.visited(_padded(unit(raw[some])))
                    yield cells_to_blocks(cells, ids[some][row], raw[some][row], BLOCK_ROWS, kind)

        def block(ids, data):
            own = np.frombuffer(ids, "<i8").reshape(-1, 2)
            raw = np.frombuffer(data, kind).reshape(len(own), -1)
            return own[:, 0], _padded(unit(raw)), own[:, 1]

        def link_task(frames):
            for frame in frames:
                for r in frame.itertuples():
                    ids, x, copies = block(r.ids, r.data)
                    q_ids, q, q_copies = block(r.q_ids, r.q_data)
                    linked = _links(q, x, least) & (q_ids[:, None] != ids[None, :])
                    has_q, has_x = linked.any(axis=1), linked.any(axis=0)
                    if not has_q.any():
                        continue
                    linked, q_ids, ids = linked[has_q][:, has_x], q_ids[has_q], ids[has_x]
                    # A member that does not visit the cell of its visitor is counted here.
                    alone = linked & ~index.visits(x[has_x], index.cells(q[has_q])).T
                    label = _forest(linked)
                    every = np.concatenate([q_ids, ids])
                    counts = np.concatenate([linked @ copies[has_x], alone.T @ q_copies[has_q]])
                    yield pd.DataFrame({"id": every, "root": every[label], "links": counts.astype(np.int64)})

        cells = nodes.mapInPandas(member_task, BLOCK)
        visits = nodes.mapInPandas(visit_task, BLOCK).toDF("cell", "q_ids", "q_data")
        found = written(cells.join(visits, "cell").mapInPandas(link_task, out), "found")
    else:
        found = spark.createDataFrame([], out)
    found_in = components(found, "id", "root").select(F.col("node"), "component")
    links = found.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
    named = (members.select("id", "node", "copies").join(links, "node", "left")
             .join(found_in, "node", "left")
             .select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    return whole.join(named, "id", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"))
