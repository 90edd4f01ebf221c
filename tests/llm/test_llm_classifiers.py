"""Classifiers: held-out accuracy, and defined results for odd input."""
import zlib

import numpy as np
import pytest

from chanfold.llm import bt_quality, ecoc_langid, queries
from chanfold.llm.features import keep_rows, ngram_counts

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string, label int, id double"
ODD = [(1, None, "en", "s", 1, 1.0), (2, "", None, "s", 1, 1.0), (3, "123 $$$", "de", None, None, None),
       (None, "the and of", "en", "s", 1, 1.0), (4, "the and of that", "en", "s", 1, 1.0),
       (4, "the and of that", "en", "s", 1, 1.0), (5, "the and of " * 50_000, "en", "s", 1, 1.0),
       (6, "der und die das", "de", "s", 1, 1.0), (7, "é", None, "s", 1, 1.0), (8, "日本語", None, "s", 1, 1.0)]


def test_language_held_out(spark):
    rows = queries.op8_ecoc_langid(spark, SF).collect()
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_held_out(spark):
    rows = queries.op6_bt_quality(spark, SF).collect()
    label = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.95
    good = [r["score"] for r in held if label[r["doc_id"]] == 1]
    poor = [r["score"] for r in held if label[r["doc_id"]] == 0]
    assert np.mean([g > p for g in good for p in poor]) > 0.98


def test_language_edge_cases(spark):
    df = spark.createDataFrame(ODD, DOCS).repartition(3)
    model = ecoc_langid.train(df)
    assert model.languages == ["de", "en"]
    got = {(r["doc_id"], r["lang_pred"]) for r in ecoc_langid.predict(df, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "en"), (6, "de"), (None, "en")} <= got
    assert ecoc_langid.predict(df, model).count() == len(ODD)
    assert ecoc_langid.train(df.limit(0)) is None and ecoc_langid.train(df.where("lang is null")) is None
    blind = ecoc_langid.predict(df, None).collect()
    assert {r["lang_pred"] for r in blind} == {"und"} and {r["score"] for r in blind} == {0.0}
    assert ecoc_langid.predict(df.limit(0), model).count() == 0
    one = ecoc_langid.train(df.where("lang = 'en'"))
    assert {r["lang_pred"] for r in ecoc_langid.predict(df.where("doc_id = 6"), one).collect()} == {"en"}


def test_ambiguity_is_flagged():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(w, 30)) for w in (["the", "of", "and"], ["der", "und", "die"]) for _ in range(40)]
    model = ecoc_langid.fit(ecoc_langid.vectors(texts), ["en"] * 40 + ["de"] * 40)
    langs, scores, unsure = ecoc_langid.decode(model, [texts[0], texts[50], "the of and der und die " * 3])
    assert langs[:2] == ["en", "de"] and unsure[:2] == [False, False] and scores[2] < min(scores[:2])


def test_codewords_differ():
    for n in (1, 2, 4, 9, 30):
        code = ecoc_langid.codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert code.shape[1] >= 15 and (not gaps or min(gaps) >= 4)


def test_quality_edge_cases(spark):
    df = spark.createDataFrame(ODD, DOCS).repartition(3)
    labels = spark.createDataFrame([(4, 1, "x"), (6, 1, "x"), (3, 0, "x"), (2, 0, "x"), (None, 0, "x"), (7, None, None),
                                    (4, 7, "x"), (99, 1, "x")], "doc_id long, quality int, score string")
    model = bt_quality.train(df, labels)
    rows = bt_quality.predict(df, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["predicted"] for r in rows}
    assert by[4] == 1 and by[6] == 1 and by[3] == 0 and by[2] == by[1] == 0
    assert bt_quality.train(df, labels.where("quality = 1")) is None and bt_quality.train(df.limit(0), labels) is None
    assert {r["score"] for r in bt_quality.predict(df, None).collect()} == {0.5}
    assert bt_quality.predict(df.limit(0), model).count() == 0


def test_pairwise_loss_ranks_and_thresholds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = (x[:, 1] > 0.5).astype(int)
    model = bt_quality.fit(x, y, ((y == 0).mean(), (y == 1).mean()))
    s = model.score(x)
    assert s[y == 1].min() > s[y == 0].max() - 0.2
    assert np.mean((s >= bt_quality.THRESHOLD) == (y == 1)) > 0.97


def test_ngram_counts_of_long_texts(monkeypatch):
    import chanfold.llm.features as features
    texts = [b"abcabc", b"", b"xy" * 300, b"a", b"q  r"]
    whole = ngram_counts(texts, (1, 2, 3), 256)
    monkeypatch.setattr(features, "_SLICE", 7)
    assert (ngram_counts(texts, (1, 2, 3), 256) == whole).all()
    assert whole.sum(axis=1).tolist() == [6 + 5 + 4, 0, 600 + 599 + 598, 1, 4 + 3 + 2]
    assert ngram_counts([b"q  r"], (2, 3), 256, b"  ").sum() == 2


def test_keep_rows_keeps_all_columns(spark):
    df = spark.createDataFrame(ODD, DOCS)
    kept = keep_rows(df, lambda texts: [t is None or "the" in t for t in texts])
    assert kept.schema == df.schema and kept.count() == 5 and keep_rows(df.limit(0), lambda t: []).count() == 0


@pytest.mark.parametrize("n", [3])
def test_sample_does_not_depend_on_partitioning(spark, n):
    from pyspark.sql import functions as F

    from chanfold.llm.features import sample_ids
    df = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    one = {tuple(r) for r in sample_ids(df, F.col("doc_id"), F.col("y"), n).collect()}
    two = {tuple(r) for r in sample_ids(df.repartition(7), F.col("doc_id"), F.col("y"), n).collect()}
    assert one == two and len(one) == 2 * n


def test_repeated_ids_displace_no_label(spark):
    """Every row occurs twice, and one id holds a third of the rows."""
    from collections import Counter

    from pyspark.sql import functions as F

    from chanfold.llm.features import sample_ids, training_rows
    words = {"de": "der und die das", "en": "the of and that", "fr": "le la et les"}
    langs = sorted(words)
    rows = [(i, f"{words[langs[i % 3]]} {i}", langs[i % 3]) for i in range(90)] * 2
    rows += [(0, f"{words['de']} again {k}", "de") for k in range(90)] + [(1, words["fr"], "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample = sample_ids(df, F.col("doc_id"), F.col("lang"), 40)
    labels, x = training_rows(df, sample, ecoc_langid.vectors, label=F.col("lang"))
    assert Counter(labels) == {"de": 30, "en": 30, "fr": 31} and len(x) == 91
    own = ecoc_langid.vectors([words["fr"]])[0]
    assert any((v == own).all() for v, k in zip(x, labels) if k == "fr") and not any(
        (v == own).all() for v, k in zip(x, labels) if k != "fr")
    model = ecoc_langid.train(df, max_train=60)
    assert model.languages == langs
    got = {r["doc_id"]: r["lang_pred"] for r in ecoc_langid.predict(df.where("doc_id > 1"), model).collect()}
    assert got == {i: langs[i % 3] for i in range(2, 90)}
    marks = spark.createDataFrame([(i, int(i % 3 == 1)) for i in range(90)] * 2, "doc_id long, quality int")
    model = bt_quality.train(df, marks, per_label=20)
    assert model is not None


def test_codes_and_training_with_many_labels(spark):
    code = ecoc_langid.codewords(120)
    gap = min(int((code[i] != code[j]).sum()) for i in range(120) for j in range(i))
    assert code.shape == (120, 70) and gap >= 15 and set(np.unique(code)) == {-1.0, 1.0}
    rows = [(i, f"word{i % 5000} the and", f"l{i % 5000:04d}") for i in range(15_000)]
    rows += [(20_000 + i, "der und die das nicht " * 3, "de") for i in range(50)]
    model = ecoc_langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert len(model.languages) == 120 and "de" in model.languages      # the most frequent, then by name
    assert ecoc_langid.decode(model, ["der und die das nicht"])[0] == ["de"]


def test_decoding_by_plain_loops():
    rng = np.random.default_rng(4)
    words = {"en": ["the", "of", "and"], "de": ["der", "und", "die"], "fr": ["le", "les", "est"], "es": ["el", "los", "es"]}
    texts = [" ".join(rng.choice(words[k], 12)) for k in words for _ in range(30)]
    model = ecoc_langid.fit(ecoc_langid.vectors(texts), [k for k in words for _ in range(30)])
    asked = [texts[3], texts[70], "the und le", "zzz qqq", "los es el der"]
    langs, scores, _ = ecoc_langid.decode(model, asked)
    for text, lang, score in zip(asked, langs, scores):
        margin = [sum(f * w for f, w in zip(ecoc_langid.vectors([text])[0].tolist(), model.weights[:, b].tolist()))
                  + model.bias[b] for b in range(model.code.shape[1])]
        loss = [sum(t * np.log1p(np.exp(-c * m)) for t, c, m in zip(model.trust, word, margin)) for word in model.code]
        assert lang == model.languages[int(np.argmin(loss))]
        assert abs(score - 1 / sum(np.exp(min(loss) - x) for x in loss)) < 1e-4


def test_pairwise_fit_by_plain_loops():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=60) > 0).astype(int)
    model = bt_quality.fit(x, y, (0.4, 0.6), max_pairs=300, steps=40)
    z = (x - model.mean) / model.scale
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    pick = np.random.default_rng(11)
    pairs = list(zip(pick.choice(good, 300), pick.choice(poor, 300)))
    w, v = np.zeros(4), np.zeros(4)
    for k in range(40):
        look = w + k / (k + 3) * v
        slope = 1e-3 * look
        for i, j in pairs:                                       # the mean of log(1 + exp(-(s_i - s_j)))
            d = (z[i] - z[j]).astype(float)
            slope = slope - d / (1 + np.exp(d @ look)) / 300
        v, w = look - 0.05 * slope - w, look - 0.05 * slope
    assert np.allclose(w, model.weights, rtol=1e-4, atol=1e-6)
    s = z @ w
    cost = lambda t: (0.6 * np.mean(s[good] < t) + 0.4 * np.mean(s[poor] >= t))
    cuts = np.sort(s)
    least = min(cost(t) for t in [cuts[0] - 1, *((cuts[1:] + cuts[:-1]) / 2), cuts[-1] + 1])
    assert abs(cost(model.threshold) - least) < 1e-9


def test_every_labelled_document_takes_part(spark, monkeypatch):
    """Nine groups: each labelled document is in one at least, the few good ones
    in several, and the threshold follows all of them."""
    from chanfold.llm.features import deal, labelled_vectors
    rows = [(i, "Fine words stand here in good order" if i % 9 == 0 else f"$$ {i} 0 {i} %%", None) for i in range(360)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    marks = spark.createDataFrame([(str(i), int(i % 9 == 0)) for i in range(360)] * 2, "id string, label int")
    own = labelled_vectors(df, marks, bt_quality.vectors).cache()
    assert own.count() == 360
    dealt = deal(own, {0: 320, 1: 40}, 40, 10).select("place", "label", "group").collect()
    assert len({r["place"] for r in dealt}) == 360 and {r["group"] for r in dealt} == set(range(9))
    assert len(set(dealt)) == len(dealt) == 320 + 3 * 40
    y = np.array([0] * 300 + [1] * 7)
    i, j = bt_quality.pairs(y, 50)
    assert len(i) == len(j) == 300 and set(i) == set(range(300, 307)) and set(j) == set(range(300))
    # The rows beyond the first of each label decide: they alone tell the labels apart.
    seen = []
    monkeypatch.setattr(bt_quality, "cut", lambda s, good, poor, old=bt_quality.cut: seen.append((good, poor)) or old(s, good, poor))
    model = bt_quality.train(df, marks.select(marks.id.cast("long").alias("doc_id"), marks.label.alias("quality")), per_label=20)
    (good, poor), = seen
    assert abs(good.sum() - 1 / 9) < 1e-9 and abs(poor.sum() - 8 / 9) < 1e-9
    assert np.allclose(model.mean, bt_quality.vectors([r[1] for r in rows]).mean(axis=0), atol=1e-5)
    got = bt_quality.predict(df, model).collect()
    assert all(r["predicted"] == (r["doc_id"] % 9 == 0) for r in got)
