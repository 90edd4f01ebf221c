"""N-gram Jaccard join with a token-group matrix.

Two texts link when ``100 * |A & B| >= percent * |A | B|`` for their sets of
word shingles.  The steps, each a Spark job over all rows:

1. Texts with equal sets form a class; a class is one node from here on.
2. Nodes that agree in a band of min-hashes are compared with the node of that
   band's bucket that shares most buckets with others; the links found this way
   make clusters (their connected components).  Groups are made of similar nodes:
   a cluster that is larger than a block is cut into groups, and smaller ones
   that look to the same leader, linked with it or not, share groups.
3. The token-group matrix holds, for each token, the groups with that token in
   the union of their members' prefixes.  A node's prefix is its ``n - need + k``
   first tokens in one order of all tokens, where ``need`` is the least overlap
   with a linked set and ``k`` grows with n.  Nodes that link share at least the
   smaller ``k`` of the two within their prefixes, so the overlap of two rows of
   the matrix bounds what any two members can share: a group opens another one
   only if the overlap of their rows reaches the smaller ``k`` of their members,
   and if some members' sizes fit.
4. Groups that open each other, and groups of several clusters by themselves,
   meet as rows.  Short signatures rule out nearly all pairs of members of
   different clusters that do not link; the others are compared exactly, and the
   components of all links are the result.

Links inside a cluster need no search, since components do not change by them;
so thousands of near copies cost a comparison or two each.
The token order puts frequent tokens last (those of several sets of a sample,
the ``most_common`` most frequent of them, in ascending order).  It decides how
many groups are opened, never which links are found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanfold.llm.common import delete, mix, python_tasks, release, written
from chanfold.llm.components import components
from chanfold.llm.shingles import column_sets

BANDS, ROWS = 6, 3
#: One of so many sets is in the sample that orders tokens.
SAMPLE = 16
#: A prefix is one token longer for each so many tokens of a set.
STEP = 40
#: A token in more groups than this is joined once per pair of groups, unless a
#: group has more than ``HOT_TOKENS`` of them.
HOT_GROUPS, HOT_TOKENS = 32, 256
#: Members and shingles of a group, on average at most.
GROUP_NODES, GROUP_SHINGLES = 32, 1 << 17
#: Sets up to this size are given by 16 bits of each shingle, larger ones by 32.
SMALL_SET = 8192
#: Rows up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000

_FACTORS = np.random.default_rng(31).integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SKETCH = ("doc_id long, text_hash long, n long, f1 long, f2 long, bands array<long>, "
          "token long, of_set int")


def _bounded(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets that are not empty, laid end to end: their numbers, starts and items."""
    full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    starts = np.cumsum([0, *(len(sets[i]) for i in full)])[:-1]
    return full, starts, np.concatenate([sets[i] for i in full]) if len(full) else np.zeros(0, np.uint64)


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set (0 for empty ones)."""
    f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    full, starts, flat = _flat(sets)
    if len(full):
        f1[full] = np.add.reduceat(mix(flat ^ np.uint64(77)), starts)
        f2[full] = np.bitwise_xor.reduceat(flat, starts)
    return f1.view(np.int64), f2.view(np.int64)


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BANDS), np.uint64)
    full, starts, flat = _flat(sets)
    if len(full):
        low = np.stack([mix(np.minimum.reduceat(mix(flat * f), starts)) for f in _FACTORS])
        low = low.reshape(BANDS, ROWS, -1)
        out[full] = mix(sum(low[:, r] * np.uint64(2 * r + 1) for r in range(ROWS))).T
    return out.view(np.int64)


def sketches(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """A row per text (set size, 128-bit fingerprint, band keys) and, with null
    n, the tokens of the sets in the sample with bits of their set."""
    python_tasks(docs.sparkSession)
    names = ["doc_id", "text_hash", "n", "f1", "f2", "bands", "token", "of_set"]

    def task(batches):
        for batch in batches:
            lo, seen = 0, set()
            for sets in column_sets(batch.column("text"), width):
                size, some = len(sets), batch.slice(lo, len(sets))
                lo += size
                f1, f2 = _fingerprints(sets)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * BANDS, pa.int32()),
                                                pa.array(_bands(sets).ravel()))
                yield pa.record_batch([some.column("doc_id"), some.column("text_hash"),
                                       pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2), keys,
                                       pa.nulls(size, pa.int64()), pa.nulls(size, pa.int32())], names=names)
                own = [i for i in np.flatnonzero(f1 % SAMPLE == 0).tolist()
                       if len(sets[i]) and f1[i] not in seen and not seen.add(f1[i])]
                if own:
                    token = np.concatenate([sets[i] for i in own]).view(np.int64)
                    of_set = np.repeat((f1[own] >> 32).astype(np.int32), [len(sets[i]) for i in own])
                    none = pa.nulls(len(token), pa.int64())
                    yield pa.record_batch([none, none, none, none, none, pa.nulls(len(token), pa.list_(pa.int64())),
                                           pa.array(token), pa.array(of_set)], names=names)
        release()

    return _rows(docs, id_col, text_col).mapInArrow(task, SKETCH)


def _late_tokens(sketch: DataFrame, most_common: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of several sets of the sample, sorted, at most ``most_common`` of
    them, and the rank of each by its number of sets."""
    counts = (sketch.where(F.col("token").isNotNull()).groupBy("token")
              .agg(F.count(F.lit(1)).alias("sets"), F.min("of_set").alias("lo"), F.max("of_set").alias("hi"))
              .where("lo <> hi").orderBy(F.desc("sets"), "token").limit(most_common))
    got = counts.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(got)
    return got[order], (len(got) - order).astype(np.int32)


def _prefix(s: np.ndarray, late: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set, and how many of its last tokens are late ones."""
    need = -(-len(s) * percent // 100)
    size = len(s) - need + min(need, 1 + len(s) // STEP)
    at = np.minimum(np.searchsorted(late, s), max(len(late) - 1, 0))
    is_late = late[at] == s if len(late) else np.zeros(len(s), bool)
    early = s[~is_late][:size]
    if len(early) == size:
        return early, 0
    last = s[is_late][np.argsort(rank[at[is_late]])][:size - len(early)]
    return np.concatenate([early, last]), len(last)


def _per_node(nodes_wanted: DataFrame, docs: DataFrame, name: str, work) -> DataFrame:
    """A written row for each wanted node (nid, doc_id, text_hash), made by
    ``work`` of (nid, text)."""
    wanted = written(nodes_wanted, "wanted")
    found = written(work(docs.join(_bounded(wanted), ["doc_id", "text_hash"]).select("nid", "text")), name)
    # Rows that repeat id and text are the same node.
    once = found if found.count() == wanted.count() else written(found.dropDuplicates(["nid"]), name)
    delete(docs.sparkSession, wanted)
    return once


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Of written ``pairs`` (a, b) of nodes, those that link.  ``docs``: doc_id,
    text_hash, text; ``nodes``: nid, doc_id, text_hash."""
    ends = pairs.select(F.col("a").alias("nid")).union(pairs.select("b")).distinct()
    texts = _per_node(ends.join(nodes.select("nid", "doc_id", "text_hash"), "nid"), docs, "texts", lambda t: t)

    def task(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                one, two = ([s for some in column_sets(part.column(c), width) for s in some] for c in ("text_a", "text_b"))
                keep = []
                for x, y in zip(one, two):
                    both = len(x) + len(y)
                    shared = both - len(np.union1d(x, y))
                    keep.append(100 * shared >= percent * (both - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("nid").alias(side), F.col("text").alias(f"text_{side}")), side)
    links = written(pairs.select("a", "b", "text_a", "text_b").mapInArrow(task, "a long, b long"), "links")
    delete(docs.sparkSession, texts)
    return links


def _grouped(nodes: DataFrame, links: DataFrame, first: DataFrame) -> DataFrame:
    """``nodes`` with cluster (the component of a linked node, else itself) and
    grp.  Large clusters and many clusters of one leader are dealt by hashes."""
    found = components(links).select(F.col("node").alias("nid"), "component")
    nodes = (nodes.join(found, "nid", "left").join(first.select(F.col("a").alias("nid"), "b"), "nid", "left")
             .withColumn("cluster", F.coalesce("component", "nid")).drop("component"))
    nodes = written(nodes, "clusters")
    parts = lambda n, shingles: F.ceil(F.greatest(n / GROUP_NODES, shingles / GROUP_SHINGLES))
    clusters = nodes.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min(F.coalesce("b", "nid")).alias("leader"))
    clusters = written(clusters.withColumn("parts", parts(F.col("size"), F.col("shingles"))), "cluster-sizes")
    small = clusters.where("parts = 1").groupBy("leader").agg(
        parts(F.sum("size"), F.sum("shingles")).alias("shares"))
    clusters = clusters.join(small, "leader", "left").select("cluster", "leader", "parts", "shares")
    grp = F.when(F.col("parts") > 1, F.xxhash64(F.lit(1), "cluster", F.pmod(F.xxhash64("nid"), F.col("parts")))).otherwise(
        F.xxhash64(F.lit(0), "leader", F.pmod(F.xxhash64("cluster"), F.col("shares"))))
    return written(nodes.join(clusters, "cluster").withColumn("grp", grp)
                   .select("nid", "n", "f1", "f2", "n_copies", "doc_id", "text_hash", "cluster", "grp"), "groups")


def _similar(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links between nodes and the leaders of their buckets, and the first
    leader (a, b) of each node that has one.  A bucket's leader is the node with
    the largest buckets in sum."""
    own = nodes.select("nid", F.posexplode("bands").alias("band", "key"))
    several = own.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    own = written(own.join(several, ["band", "key"]), "buckets")
    weight = own.groupBy("nid").agg(F.sum("size").alias("weight"))
    lead = (own.join(weight, "nid").groupBy("band", "key")
            .agg(F.max(F.struct("weight", (-F.col("nid")).alias("minus"))).alias("lead")))
    leaders = written(own.join(lead, ["band", "key"]).where(F.col("nid") != -F.col("lead.minus"))
                      .select(F.col("nid").alias("a"), "lead.*").distinct(), "leaders")
    best = leaders.groupBy("a").agg(F.max(F.struct("weight", "minus")).alias("best"))
    first = written(best.select("a", (-F.col("best.minus")).alias("b")), "first-pairs")
    links = _linked(first, docs, nodes, width, percent)
    # The other leaders, where that did not put both into one star.
    star = written(links.toDF("nid", "star"), "stars")
    side = _bounded(star)
    rest = leaders.select("a", (-F.col("minus")).alias("b")).join(first, ["a", "b"], "left_anti")
    rest = (rest.join(side.toDF("a", "star_a"), "a", "left").join(side.toDF("b", "star_b"), "b", "left")
            .where(F.coalesce("star_a", "a") != F.coalesce("star_b", "b")).select("a", "b"))
    return links.unionByName(_linked(written(rest, "rest-pairs"), docs, nodes, width, percent)), first


def _matrix(docs: DataFrame, nodes: DataFrame, sketch: DataFrame, width: int, percent: int,
            most_common: int) -> DataFrame:
    """token, grp for the tokens that several nodes have in their prefix."""
    order = docs.sparkSession.sparkContext.broadcast(_late_tokens(sketch, most_common))

    def prefixes(batches):
        late, rank = order.value
        for batch in batches:
            seen = set()
            for sets in column_sets(batch.column("text"), width):
                f1, _ = _fingerprints(sets)
                own = [i for i, f in enumerate(f1.tolist()) if len(sets[i]) and f not in seen and not seen.add(f)]
                got = [_prefix(sets[i], late, rank, percent) for i in own]
                if got:
                    lens = np.array([len(p) for p, _ in got])
                    back = np.repeat(np.cumsum(lens), lens) - np.arange(lens.sum())     # 1 for a prefix's last token
                    is_late = back <= np.repeat([n for _, n in got], lens)
                    yield pa.record_batch([pa.array(np.concatenate([p for p, _ in got]).view(np.int64)),
                                           pa.array(np.repeat(f1[own], lens)), pa.array(is_late)],
                                          names=["token", "f1", "late"])
        release()

    postings = docs.mapInArrow(prefixes, "token long, f1 long, late boolean")
    # Late tokens stand in several sets of the sample; the others are rare.
    same = Window.partitionBy("token", "apart")
    shared = (postings.withColumn("apart", F.when(F.col("late"), F.col("f1")))
              .select("token", "f1", "late", F.min("f1").over(same).alias("lo"), F.max("f1").over(same).alias("hi"))
              .where("late or lo <> hi").select("token", "f1").distinct())
    return written(shared.join(nodes.select("f1", "grp"), "f1").select("token", "grp").distinct(), "matrix")


def _opened(matrix: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of groups whose rows of the matrix overlap enough, x < y,
    and groups of several clusters with themselves.  ``groups``: grp, least, most
    (set sizes), k, lo, hi (clusters)."""
    wide = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("n_groups")).where("n_groups > 1")
    rows = written(matrix.join(wide, "token").join(groups, "grp"), "shared-tokens")
    hot = rows.where(F.col("n_groups") > HOT_GROUPS)
    lists = (hot.groupBy("grp").agg(F.count(F.lit(1)).alias("n_hot")).where(F.col("n_hot") <= HOT_TOKENS)
             .join(hot, "grp").groupBy("grp").agg(F.sort_array(F.collect_set("token")).alias("hot")))
    hot = written(hot.join(lists, "grp", "left"), "hot-tokens")

    def pairs(rows: DataFrame, *more: str) -> DataFrame:
        x, y = (rows.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("grp", "least", "most", "k", "lo", "hi", *more)))
                for side in ("x", "y"))
        fit = ((100 * F.col("most_x") >= percent * F.col("least_y")) & (100 * F.col("most_y") >= percent * F.col("least_x")))
        one = (F.col("lo_x") == F.col("hi_y")) & (F.col("hi_x") == F.col("lo_y"))
        first = ~one
        if more:
            first &= F.coalesce(F.get(F.array_intersect("hot_x", "hot_y"), F.lit(0)) == F.col("token"), F.lit(True))
        return x.join(y.withColumnRenamed("token", "token_y"), (F.col("token") == F.col("token_y"))
                      & (F.col("grp_x") < F.col("grp_y")) & fit & first)

    ends = [F.col("grp_x").alias("x"), F.col("grp_y").alias("y"), F.least("k_x", "k_y").alias("k")]
    shared = F.coalesce(F.size(F.array_intersect("hot_x", "hot_y")), F.lit(1))
    found = pairs(rows.where(F.col("n_groups") <= HOT_GROUPS)).select(*ends, F.lit(1).alias("shared")).unionByName(
        pairs(hot, "hot").select(*ends, F.when(F.col("hot_x").isNull() | F.col("hot_y").isNull(), 1)
                                 .otherwise(shared).alias("shared")))
    found = found.groupBy("x", "y", "k").agg(F.sum("shared").alias("shared")).where("shared >= k").select("x", "y")
    return written(found.unionByName(groups.where("lo <> hi").select(F.col("grp").alias("x"), F.col("grp").alias("y"))),
                   "opened")


def _signature(s: np.ndarray) -> bytes:
    """Distinct bits of each shingle, sorted."""
    bits = np.uint16 if len(s) <= SMALL_SET else np.uint32
    return np.unique((s >> np.uint64(20)).astype(bits)).tobytes()


def _may_link(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes, percent: int) -> bool:
    """A shingle of A whose bits do not occur in B is not in B, so
    ``|A & B| <= |A| - missing``, and the same from B."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    x, y = (np.frombuffer(b, np.uint16 if n <= SMALL_SET else np.uint32) for n, b in ((n_a, bits_a), (n_b, bits_b)))
    if x.dtype != y.dtype:
        x, y = np.unique(x.astype(np.uint16)), np.unique(y.astype(np.uint16))
    shared = len(x) + len(y) - len(np.union1d(x, y))
    most = min(n_a - len(x), n_b - len(y)) + shared
    return 100 * most >= percent * (n_a + n_b - most)


def _candidates(opened: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members of groups that open each other, of different
    clusters, which signatures do not rule out."""
    wanted = opened.select(F.col("x").alias("grp")).union(opened.select("y")).distinct()
    nodes = nodes.join(wanted, "grp")

    def signatures(batches):
        for batch in batches:
            lo = 0
            for sets in column_sets(batch.column("text"), width):
                some = batch.slice(lo, len(sets))
                lo += len(sets)
                yield pa.record_batch([some.column("nid"), pa.array([_signature(s) for s in sets], pa.binary())],
                                      names=["nid", "bits"])
        release()

    rows = _per_node(nodes.select("nid", "doc_id", "text_hash"), docs, "signatures",
                     lambda t: t.mapInArrow(signatures, "nid long, bits binary"))
    members = written(rows.join(nodes.select("nid", "grp", "cluster", "n"), "nid").groupBy("grp")
                      .agg(F.collect_list(F.struct("nid", "cluster", "n", "bits")).alias("own")), "members")

    def task(batches):
        for batch in batches:
            a, b = [], []
            for k in range(batch.num_rows):
                x, y, one, two = (batch.column(c).slice(k, 1).to_pylist()[0] for c in ("x", "y", "own_x", "own_y"))
                for i, p in enumerate(one):
                    for q in two[i + 1:] if x == y else two:
                        if p["cluster"] != q["cluster"] and _may_link(p["n"], p["bits"], q["n"], q["bits"], percent):
                            a.append(p["nid"])
                            b.append(q["nid"])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        release()

    for side in ("x", "y"):
        opened = opened.join(members.select(F.col("grp").alias(side), F.col("own").alias(f"own_{side}")), side)
    return written(opened.select("x", "y", "own_x", "own_y").mapInArrow(task, "a long, b long"), "candidates")


def _search(docs: DataFrame, percent: int, width: int, most_common: int, id_col: str, text_col: str):
    """The written sketch, the classes with their clusters, and the links inside
    clusters and between them."""
    sketch = written(sketches(docs, width, id_col, text_col), "sketches")
    docs = _rows(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    linkable = sketch.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = linkable.groupBy("n", "f1", "f2").agg(
        F.min(F.struct("doc_id", "text_hash", "bands")).alias("first"), F.count(F.lit(1)).alias("n_copies"))
    nodes = written(classes.select(F.monotonically_increasing_id().alias("nid"), "n", "f1", "f2",
                                   "n_copies", "first.*"), "nodes")
    near, first = _similar(nodes, docs, width, percent)
    nodes = _grouped(nodes, near, first)
    k = F.least(F.ceil(F.col("n") * percent / 100), 1 + F.floor(F.col("n") / STEP))
    groups = written(nodes.groupBy("grp").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min(k).alias("k"), F.min("cluster").alias("lo"),
        F.max("cluster").alias("hi")), "group-sizes")
    matrix = _matrix(docs, nodes, sketch, width, percent, most_common)
    pairs = _candidates(_opened(matrix, groups, percent), docs, nodes, width, percent)
    return sketch, nodes, near, _linked(pairs, docs, nodes, width, percent)


def join(docs: DataFrame, percent: int = 75, width: int = 5, most_common: int = 500_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash (xxhash64 of the text),
    n_shingles (size of the set), component_id (smallest doc_id reachable by links, itself
    included) and n_copies (rows with the same set, itself included).

    Texts that are null, empty or without words have an empty set and link
    with nothing.  Rows that repeat a doc_id are separate texts and link only
    by their sets.  Rows with a null doc_id get a null component and take part
    in no link.  Other columns are ignored."""
    sketch, nodes, _, links = _search(docs, percent, width, most_common, id_col, text_col)
    # The links inside clusters made the clusters; the others join clusters.
    of = nodes.select("nid", "cluster")
    across = (links.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").select("x", "y").distinct())
    found = components(across, "x", "y").select(F.col("node").alias("cluster"), "component")
    named = (nodes.select("n", "f1", "f2", "n_copies", "doc_id", "cluster").join(_bounded(found), "cluster", "left")
             .withColumn("component", F.coalesce("component", "cluster")))
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(ids, "component").select("n", "f1", "f2", "n_copies", "component_id")
    texts = sketch.where(F.col("n").isNotNull())
    linkable = texts.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    linked = linkable.select("doc_id", "text_hash", "n", "f1", "f2").join(named, ["n", "f1", "f2"]).select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", "n_copies")
    alone = texts.where((F.col("n") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(1).cast("long").alias("n_copies"))
    return linked.unionByName(alone)


def representative_links(docs: DataFrame, percent: int = 75, width: int = 5, most_common: int = 500_000,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The links that were found, between the smallest doc_ids of classes of
    equal sets: doc_id_a, doc_id_b and the rows of both classes, n_copies_a and
    n_copies_b.  They hold every link between different clusters and enough
    links inside each cluster to connect it, not all of those."""
    _, nodes, near, links = _search(docs, percent, width, most_common, id_col, text_col)
    out = near.unionByName(links).distinct()
    for side in ("a", "b"):
        out = out.join(nodes.select(F.col("nid").alias(side), F.col("doc_id").alias(f"doc_id_{side}"),
                                    F.col("n_copies").alias(f"n_copies_{side}")), side)
    return out.select("doc_id_a", "doc_id_b", "n_copies_a", "n_copies_b")
