"""The pipeline's stages against what their operators decide row by row."""
import collections

import corpus_pipeline as C
from chanfold.llm import bin_completion, bt_quality, ecoc_langid, line_chunks, queries

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and "pipeline" not in E.oracle_sql()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = bt_quality.train(docs, labels)
    kept = {}
    for k, (name, stage) in enumerate(C.STAGES):
        before = docs
        stage(spark, before, SF).write.parquet(f"{tmpdir_path}/{k}")
        docs = spark.read.parquet(f"{tmpdir_path}/{k}")
        kept[name] = (before, docs)
        if k < len(C.STAGES) - 1:
            assert docs.columns == before.columns and docs.count()
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    before, after = kept["quality classifier"]
    texts = rows(before)
    ids = list(texts)
    want = {i for i, s in zip(ids, bt_quality.scores(model, [texts[i] for i in ids])) if s >= bt_quality.THRESHOLD}
    assert set(rows(after)) == want and 0 < len(want) < len(ids)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(i in want for i in ids if quality.get(i) == 1)
    assert not any(i in want for i in ids if quality.get(i) == 0)

    before, after = kept["language ID"]
    texts = rows(before)
    model = ecoc_langid.train(before)
    langs, scores, _ = ecoc_langid.decode(model, list(texts.values()))
    want = {i for i, k, s in zip(texts, langs, scores) if k != "und" and s >= C.LEAST_LANGUAGE_SCORE}
    assert set(rows(after)) == want

    before, after = kept["line dedup"]
    from test_llm_near import least, removed_by_windows, word_set
    texts, first = rows(before), {}
    gone = removed_by_windows(sorted(texts.items()), 50)
    for i, t in sorted(texts.items()):
        lines = t.split("\n")
        for lo, hi, counts in line_chunks.chunks(t, 12, 50):
            if counts and first.setdefault("\n".join(lines[lo:hi]), (i, lo)) != (i, lo):
                gone[i] |= set(range(lo, hi))
    left = rows(after)
    assert left == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in texts.items()}
    assert any(gone.values()) and not any(removed_by_windows(sorted(left.items()), 50).values())
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = kept["n-gram Jaccard join"]
    texts = sorted(rows(before).items())
    sets = [word_set(t) for _, t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = least(links, len(sets))
    assert set(rows(after)) == {texts[i][0] for i in range(len(sets)) if label[i] == i}

    before, after = kept["best-fit packing"]
    used = collections.Counter()
    for r in after.collect():
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 1024 and {r["doc_id"] for r in after.collect()} == set(rows(before))
    sizes = collections.Counter(r["length"] for r in after.collect())
    assert len(used) <= sum(n for _, n in bin_completion.best_fit(sizes, 1024))


def test_stages_take_odd_rows(spark, tmpdir_path):
    rows = [(1, "the and of that for with", "en", "s", 24, "x"), (1, "the and of that for with", "en", "s", 24, "x"),
            (2, None, None, None, None, None), (None, "the and of that", "en", "s", 15, "x"), (3, "", "en", "s", 0, "x"),
            (4, "the and of " * 30_000, "en", "s", 330_000, "x"), (5, "the and of that for with", "en", "s", 24, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        for name, stage in C.STAGES:
            out = stage(spark, table, tmpdir_path)
            got = out.collect()
            if not table.take(1):
                assert not got
    assert C.quality(spark, docs, tmpdir_path).count() == 7          # nothing to learn from
    near = C.near_duplicates(spark, docs, tmpdir_path).collect()
    assert sorted((r["doc_id"] or 0) for r in near) == [0, 1, 2, 3, 4]
    assert C.language(spark, docs, tmpdir_path).count() == 5
