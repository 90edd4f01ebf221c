"""Near duplicates, neighbour search and line dedup against brute force."""
import collections
import itertools
import random
import re
import tracemalloc

import numpy as np
import pytest

from chanfold.llm import components, jaccard_join, line_chunks, multi_index, multiprobe_lsh, shingles
from chanfold.llm.vectors import unit

DOCS = "doc_id long, text string, n string, nid int, token string, component_id double"
VECS = "vec_id long, embedding array<double>, id string, cell int, score string"


def least(links, n):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return [root(i) for i in range(n)]


def word_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def make_texts(seed=5):
    """Near-copy families, a large family, a passage in many texts, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(40)]
    texts = []
    for family, copies, edits in ((40, 3, 1), (60, 5, 3), (30, 4, 2), (200, 3, 12), (80, 60, 4), (50, 6, 8)):
        base = [word() for _ in range(family)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(family)] = word()
            texts.append(" ".join(own))
    for k in range(60):
        own = [word() for _ in range(rng.choice([2, 6, 12, 60]))]
        texts.append(" ".join(own[:1] + passage + own[1:]))
    texts += ["", "  \t\n", "one", "ONE", "one two", "one  two\n", "a b c d e", "A B C D e", "é É", texts[0].upper()]
    return texts


def test_shingle_sets_are_the_words_sets():
    texts = make_texts() + [None, "x " * 5, "\x1c a b \x0b c", "w" * 3000 + " v"]
    sets = shingles.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(word_set(t)) for t in texts]
    seen = {}
    for t, s in zip(texts, sets):
        assert seen.setdefault(s.tobytes(), word_set(t)) == word_set(t)


def test_shingles_of_long_texts_and_words(monkeypatch):
    texts = make_texts()[:40] + ["abc" * 200 + " d e f g " + "h" * 90]
    whole = shingles.shingle_sets(texts)
    long = "z" * (2 * shingles._SLICE + 5)
    a, b, c = shingles.shingle_sets([f"p q r s {long} t", f"p q r s {long[:-1]}y t", f"p q r s {long} t"])
    assert len(a) == 2 and (a == c).all() and not np.intersect1d(a, b).size
    joined = shingles.shingle_sets([" ".join(texts)])[0]
    monkeypatch.setattr(shingles, "_SLICE", 700)
    assert all((x == y).all() for x, y in zip(whole[:-1], shingles.shingle_sets(texts[:-1])))
    assert (shingles.shingle_sets([" ".join(texts)])[0] == joined).all()


@pytest.mark.parametrize("grouped", [True, False])       # without groups all links are left to the matrix
def test_jaccard_join_is_exact(spark, monkeypatch, grouped):
    monkeypatch.setattr(jaccard_join, "HOT_GROUPS", 3)
    monkeypatch.setattr(jaccard_join, "HOT_TOKENS", 30)
    monkeypatch.setattr(jaccard_join, "GROUP_NODES", 4)
    if not grouped:
        none = lambda nodes: nodes.selectExpr("nid AS a", "nid AS b").limit(0)
        monkeypatch.setattr(jaccard_join, "_similar", lambda nodes, *_: (none(nodes), none(nodes)))
    texts = make_texts()
    rows = [(3 * i - 7, t, "x", i, None, 0.5) for i, t in enumerate(texts)]
    rows += [(None, texts[0], "x", 1, "t", 0.1), (None, None, None, None, None, None), (10_000, None, "x", 1, "t", 1.0),
             (-7, texts[-12], "x", 1, "t", 1.0), (-7, texts[0], "x", 1, "t", 1.0)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df).collect())
    own = [r for r in rows if r[0] is not None]
    sets = [word_set(r[1]) for r in own]
    links = [(i, j) for i in range(len(own)) for j in range(i)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    label = least(links, len(own))
    ids = collections.defaultdict(list)
    for i, r in enumerate(own):
        ids[label[i]].append(r[0])
    want = collections.Counter((r[0], len(sets[i]), min(ids[label[i]])) for i, r in enumerate(own))
    want.update((None, len(word_set(r[1])), None) for r in rows if r[0] is None)
    assert got == want
    assert len(links) > 100
    if grouped:
        return
    smallest = [min(r[0] for r, s in zip(own, sets) if s == mine) for mine in sets]
    known = {frozenset((smallest[i], smallest[j])) for i, j in links}
    found = {(r["doc_id_a"], r["doc_id_b"]) for r in jaccard_join.representative_links(df).collect()}
    assert found and {frozenset(x) for x in found} <= known


def test_signatures_rule_out_no_link(monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_SET", 60)       # sets of both widths meet
    rng, out = np.random.default_rng(3), 0
    for n in (3, 10, 55, 58, 62, 70, 400):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for _ in range(60):
            a, b = (np.unique(np.concatenate([base[rng.random(n) < rng.choice([0.6, 0.95, 1])], rng.integers(
                0, 1 << 63, int(rng.integers(0, 1 + n // 4)), dtype=np.uint64)])) for _ in range(2))
            both = len(np.union1d(a, b))
            links = 100 * (len(a) + len(b) - both) >= 75 * both and both > 0
            may = len(a) and len(b) and jaccard_join._may_link(
                len(a), jaccard_join._signature(a), len(b), jaccard_join._signature(b), 75)
            assert may or not links
            out += not may
    assert out > 100


def test_jaccard_join_of_a_cloud_that_nearly_links(spark):
    """Texts that share a passage but do not link, beside one family that does."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6)))
    passage = [word() for _ in range(60)]
    texts = [" ".join([word() for _ in range(12)] + passage + [word() for _ in range(8)]) for _ in range(70)]
    for k in range(50):
        own = list(passage) + ["tail"]
        own[k] = word()
        texts.append(" ".join(own))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    sets = [word_set(t) for t in texts]
    label = least([(i, j) for i in range(len(sets)) for j in range(i)
                   if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])], len(sets))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df).collect()}
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}
    assert len(set(label)) > 60


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.join(spark.createDataFrame([], DOCS)).count() == 0
    only = spark.createDataFrame([(1, None, "x", 1, "t", 1.0)], DOCS)
    assert [tuple(r)[0:1] + tuple(r)[2:4] for r in jaccard_join.join(only).collect()] == [(1, 0, 1)]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500), (7, 7)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    got = {r["node"]: r["component"] for r in components.components(
        spark.createDataFrame(links, "a long, b long").repartition(4)).collect()}
    label = least(links, 1200)
    assert got == {i: label[i] for a, b in links if a != b for i in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed=1, n=900, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[100:160] = x[100] + 0.05 * rng.normal(size=(60, dim))
    x[200:230] = x[200]
    x[231] = 3 * x[230]
    x[300] *= 1e200
    x[301] = x[300] * 1e-350
    return x


def vector_rows(x):
    rows = [(i, v.tolist(), "x", i, "s") for i, v in enumerate(x)]
    bad = [None, [], [0.0] * x.shape[1], [1.0, None] + [0.5] * (x.shape[1] - 2), [float("nan")] + [1.0] * (x.shape[1] - 1),
           [float("inf")] + [1.0] * (x.shape[1] - 1), [1.0, 2.0]]
    rows += [(5000 + 50 * i, v, None, None, None) for i, v in enumerate(bad)]
    return rows + [(None, x[0].tolist(), "x", 1, "s"), rows[3]]


def test_search(spark):
    x = vectors()
    x[301] = 2 * x[302]
    df = spark.createDataFrame(vector_rows(x), VECS).repartition(4)
    got = collections.defaultdict(list)
    for r in multiprobe_lsh.search(df, df.where("vec_id % 50 = 0")).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    u = unit(x)
    assert set(got) == set(range(0, len(x), 50))
    hits = 0
    for q, own in got.items():
        own.sort()
        s = u @ u[q]
        s[q] = -2
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(abs(s[i] - score) < 1e-12 for _, i, score in own)
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
        hits += sum(score >= np.sort(s)[-5] - 1e-12 for _, _, score in own)
    assert hits >= 0.9 * 5 * len(got)
    assert [i for _, i, _ in sorted(got[200])] == [201, 202, 203, 204, 205]


def test_search_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "x", 1, "s"), (1, [1.0, 1.0], "x", 1, "s"), (2, [-1.0, 0.0], "x", 1, "s")], VECS)
    got = sorted(tuple(r) for r in multiprobe_lsh.search(df, df.where("vec_id = 0")).collect())
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert multiprobe_lsh.search(df.limit(0), df).count() == 0
    assert multiprobe_lsh.search(df, df.limit(0)).count() == 0


def test_search_with_queries_of_another_length(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4 if i % 50 == 0 else 8).tolist(), "x", 1, "s") for i in range(400)]
    df = spark.createDataFrame(rows, VECS).repartition(3)
    assert multiprobe_lsh.search(df, df.where("vec_id % 50 = 0")).count() == 0


def test_repeated_ids_give_one_result(spark):
    rng = np.random.default_rng(6)
    rows = [(i % 150, rng.normal(size=6).tolist(), "x", 1, "s") for i in range(400)]
    rows += [(i, [0.0, 0.0, 1.0, 0.0, 0.0, 1e-3 * i], "x", 1, "s") for i in range(1000, 1100)]
    got, near = [], []
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, VECS).orderBy("embedding", ascending=parts > 1).repartition(parts)
        got.append(sorted(map(tuple, multiprobe_lsh.search(df, df.where("vec_id % 50 = 0")).collect())))
        near.append(sorted(map(tuple, multi_index.near_duplicates(df).collect())))
    assert got[0] == got[1] == got[2] and near[0] == near[1] == near[2]
    assert len({r[0] for r in got[0]}) == 5 and len(near[0]) == 500


def test_short_queries_meet_all_rows(spark, monkeypatch):
    monkeypatch.setattr(multiprobe_lsh, "ASKED", 16)
    x = np.random.default_rng(7).normal(size=(300, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>").repartition(4)
    queries = df.where("id < 50")
    got = multiprobe_lsh._top(multiprobe_lsh._all_pairs(df, queries, 50, 4), 4).collect()
    u = unit(x)
    for q in range(50):
        own = sorted((r["rank"], r["id"]) for r in got if r["query"] == q)
        assert [i for _, i in own] == np.argsort(-(u @ u[q]), kind="stable")[:4].tolist()


def test_probes_come_in_order_of_cost():
    index = multiprobe_lsh.Index.new(8, 100_000, tables=2)
    q = unit(np.random.default_rng(2).normal(size=(5, 8)))
    first = index.probes(q, 2)
    own = index.cells(q)
    assert all(set(f.tolist()) == set(o.tolist()) for f, o in zip(first, own))  # both own buckets cost nothing
    whole = index.probes(q, 1 << 30)
    assert (whole[:, :50] == index.probes(q, 50)).all() and all(len(set(r.tolist())) == len(r) for r in whole)


def test_probes_are_the_sorted_product():
    index = multiprobe_lsh.Index.new(8, 20_000, tables=2)
    q = unit(np.random.default_rng(3).normal(size=(6, 8)))
    index.a[:, 1] = index.a[:, 0]                       # functions that cost the same
    index.b[1] = index.b[0]
    whole, some = index.probes(q, 1 << 30), index.probes(q, 40)
    for x, mine, first in zip(q, whole, some):
        f = (x[None] @ index.a + index.b)[0] / index.width
        slot = np.floor(f).astype(np.int64)
        at = f - slot
        ways = []
        for t in range(index.tables):
            own = range(t * index.functions, (t + 1) * index.functions)
            for moves in itertools.product(multiprobe_lsh.STEPS, repeat=index.functions):
                cost = sum((m - at[i] if m > 0 else at[i] - m - 1 if m else 0.0) ** 2 for i, m in zip(own, moves))
                code = sum(int(slot[i] + m) * int(index.salt[i]) for i, m in zip(own, moves))
                ways.append((round(cost, 9), code * index.tables + t))
        costs = {cell: cost for cost, cell in ways}
        assert sorted(costs) == sorted(mine.tolist()) and (mine[:40] == first).all()
        assert [costs[c] for c in mine.tolist()] == sorted(costs.values())


def test_calibration_holds_the_buckets_of_one_query(spark):
    x = np.random.default_rng(8).normal(size=(400, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>").repartition(3)
    index = multiprobe_lsh.Index.new(16, 600_000)       # as many functions as for a large table
    assert index.functions == 6
    tracemalloc.start()
    visits = multiprobe_lsh._visits(index, rows, 5, 128, 0.97)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 1 < visits < index.tables * 5 ** 6
    assert most < 64 << 20                              # of all 128 at once: 818 MB


def test_best_of_blocks(monkeypatch):
    monkeypatch.setattr(multiprobe_lsh, "HELD", 500)
    monkeypatch.setattr(multiprobe_lsh, "EXACT", 64)
    rng = np.random.default_rng(9)
    x = unit(rng.normal(size=(3000, 24)))
    x[500:900] = unit(x[500] + 1e-7 * rng.normal(size=(400, 24)))  # floats hardly tell these apart
    x[900:930] = x[900]
    ids = rng.permutation(10_000)[:len(x)]
    asked = np.concatenate([np.arange(0, 3000, 40), np.arange(500, 560), [900, 910]])
    best = multiprobe_lsh._Best(6)
    for lo in [*range(0, 3000, 170), 340, 850]:         # some blocks come twice, as in another table
        for q in np.array_split(asked, 5):
            best.meet(ids[lo:lo + 170], x[lo:lo + 170], ids[q], x[q])
    got = best.rows()
    for q in asked:
        score = np.clip((x * x[q]).sum(axis=1), -1, 1)
        want = np.lexsort((ids, -score))[:6]
        mine = got[0] == ids[q]
        assert got[1][mine].tolist() == ids[want].tolist() and (got[2][mine] == score[want]).all()


def test_search_of_floats_and_of_small_blocks(spark, monkeypatch):
    x = vectors(seed=4)
    x[300:302] = x[302:304]
    x = x.astype(np.float32)
    floats = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    doubles = floats.selectExpr("vec_id", "cast(embedding as array<double>) AS embedding")
    search = lambda a, b: sorted(map(tuple, multiprobe_lsh.search(a, b.where("vec_id % 50 = 0")).collect()))
    want = search(doubles, doubles)
    assert len(want) == 18 * 5
    assert search(floats, floats) == want
    for name, n in (("MEMBERS", 7), ("VISITORS", 3), ("GATHERED", 16 * 8 * 100), ("FRAME", 16 * 8 * 50), ("VISITS", 40)):
        monkeypatch.setattr(multiprobe_lsh, name, n)
    assert search(floats, doubles) == want


def test_near_duplicate_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 16)
    x = vectors()
    x[301] = 2 * x[302]
    rows = vector_rows(x)
    got = multi_index.near_duplicates(spark.createDataFrame(rows, VECS).repartition(4)).collect()
    assert len(got) == len(rows)
    u = unit(x)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    label = least(np.argwhere(near).tolist(), len(x))
    found = {r["vec_id"]: r for r in got if r["vec_id"] is not None and r["vec_id"] < 5000}
    assert all(found[i]["n_links"] <= near[i].sum() for i in range(len(x)))
    assert sum(r["n_links"] for r in found.values()) >= 0.95 * near.sum() > 1000
    assert [found[i]["component_id"] for i in range(100, 160)] == [label[i] for i in range(100, 160)]
    assert found[200]["kept"] and found[200]["n_links"] == 29 and not found[229]["kept"]
    for r in got:
        if r["vec_id"] is None:
            assert not r["kept"] and r["component_id"] is None
        elif r["vec_id"] >= 5000:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)
    assert multi_index.near_duplicates(spark.createDataFrame([], VECS)).count() == 0


@pytest.mark.parametrize("cosine", [0.91])
def test_rare_links_of_many_vectors_are_met(spark, tmpdir_path, cosine):
    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = np.random.default_rng(12)
    x = unit(rng.normal(size=(100_000, 64)))
    z = rng.normal(size=(500, 64))
    z = unit(z - (z * x[:500]).sum(axis=1, keepdims=True) * x[:500])
    x[50_000:50_500] = cosine * x[:500] + np.sqrt(1 - cosine * cosine) * z          # 1% of the rows
    column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float64()))
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": column}), f"{tmpdir_path}/v.parquet",
                   row_group_size=10_000)
    out = multi_index.near_duplicates(spark.read.parquet(f"{tmpdir_path}/v.parquet")).where("n_links > 0").collect()
    found = {r["vec_id"]: r for r in out}
    met = [i for i in range(500) if i in found and found[i]["component_id"] == found[50_000 + i]["component_id"] == i]
    assert len(met) >= 0.98 * 500 and len(found) == 2 * len(met)
    assert all(r["n_links"] == 1 for r in out)


def test_multi_sequence_is_the_sorted_product():
    rng = np.random.default_rng(4)
    index = multi_index.Index(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    x = rng.normal(size=(20, 6))
    a, b = index.distances(x)
    total = (a[:, :, None] + b[:, None, :]).reshape(20, -1)
    for most in (1, 2, 9, 35):
        assert (index.nearest_cells(x, most) == np.argsort(total, axis=1, kind="stable")[:, :most]).all()
    assert (index.cells(x) == index.nearest_cells(x, 1)[:, 0]).all()


LINES = "doc_id long, text string, lo string, hi int, body string"


def line_rows(seed=6):
    rng = random.Random(seed)
    line = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(n))
    passages = ["\n".join(line(rng.randint(6, 14)) for _ in range(8)) for _ in range(4)]
    long, short = line(60), line(9)
    rows = []
    for i in range(60):
        parts = [line(rng.randint(1, 15)) for _ in range(rng.randint(0, 6))]
        parts.insert(rng.randint(0, len(parts)), rng.choice([*passages, long, short, "", line(3)]))
        rows.append((i * 2, "\n".join(parts), "x", i, None))
    rows += [(1000, None, "x", 1, "b"), (1001, "", "x", 1, "b"), (None, passages[0], "x", 1, "b"), (6, rows[3][1], "x", 1, "b"),
             (1002, "\n\n\n", "x", 1, "b"), (1003, "\n\n\n", "x", 1, "b"), (1004, rows[8][1], "x", 1, "b")]
    return rows, passages, long, short


def test_line_dedup(spark):
    rows, passages, long, short = line_rows()
    df = spark.createDataFrame(rows, LINES).repartition(4)
    out = line_chunks.dedup(df)
    assert out.schema == df.schema
    first, want = {}, collections.Counter()
    key = lambda r: (r[0] is not None, r[0] or 0)
    for r in sorted(rows, key=key):
        if r[1] is None:
            want[r] += 1
            continue
        lines, left = r[1].split("\n"), []
        for lo, hi, counts in line_chunks.chunks(r[1], 12, 50):
            body = "\n".join(lines[lo:hi])
            if not counts or first.setdefault(body, (r[0], r[1], lo)) == (r[0], r[1], lo):
                left += lines[lo:hi]
        want[(r[0], "\n".join(left), *r[2:])] += 1
    got = collections.Counter(map(tuple, out.collect()))
    assert got == want
    texts = [r[1] for r in got.elements() if r[1]]
    assert sum(long in t for t in texts) == 1 and sum(short in t.split("\n") for t in texts) > 1
    assert line_chunks.dedup(df.limit(0)).count() == 0


def test_cuts_do_not_shift():
    rng = random.Random(8)
    body = [f"line {rng.random()} of some words" for _ in range(60)]
    cut = lambda lines: {tuple(lines[lo:hi]) for lo, hi, _ in line_chunks.chunks("\n".join(lines), 1, 50)}
    whole = cut(body)
    moved = cut(["something new", *body])
    assert len(whole & moved) >= len(whole) - 2
    assert [c for c in line_chunks.chunks("\n".join(body), 1, 50)][-1][1] == 60


@pytest.mark.parametrize("text", ["", "a", "\n", "a\n\nb"])
def test_chunks_cover_every_line(text):
    spans = [(lo, hi) for lo, hi, _ in line_chunks.chunks(text, 1, 50)]
    assert spans[0][0] == 0 and spans[-1][1] == len(text.split("\n"))
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def removed_by_windows(docs, long_words):
    """Lines of each text in a window of lines that also stands earlier."""
    seen, out = {}, {i: set() for i, _ in docs}
    for i, text in docs:
        lines = text.split("\n")
        words = [len(x.split()) for x in lines]
        for lo in range(len(lines)):
            for hi in range(lo + 1, len(lines) + 1):
                if sum(words[lo:hi]) >= long_words:
                    for d, at in seen.setdefault(tuple(lines[lo:hi]), []):
                        out[i] |= set(range(max(lo, at + hi - lo) if d == i else lo, hi))
                    seen[tuple(lines[lo:hi])].append((i, lo))
    return out


def test_every_repeated_passage_is_removed(spark):
    rng = random.Random(9)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passages = [[line(w) for _ in range(n)] for n, w in [(3, 20), (5, 12), (6, 10), (20, 10), (2, 25), (3, 16), (4, 13)] * 2]
    docs = []
    for i in range(80):
        own = passages[i % len(passages)]
        docs.append((i, "\n".join([line(rng.randint(1, 9)), *own, *([""] if i % 3 else []), line(7)])))
    docs.append((80, "\n".join([passages[0][0]] * 20)))           # a line that repeats itself
    docs.append((81, "\n".join(passages[3][4:12] + passages[3][2:9])))
    want = removed_by_windows(docs, 50)
    # Chunks of fewer words are out of the way with least_words = long_words.
    got = line_chunks.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 50, 50, passages=True)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    for i, text in docs:
        assert texts[i] == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in want[i])
    for k, own in enumerate(passages):
        words = len(" ".join(own).split())
        copies = sum("\n".join(own) in t for t in texts.values())
        assert copies == (1 if words >= 50 else len([i for i in range(80) if i % len(passages) == k]))
