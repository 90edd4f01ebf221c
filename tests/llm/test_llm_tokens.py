"""Token files, packing and byte-level BPE."""
import base64
import collections
import contextlib
import hashlib
import itertools
import os
import random
import uuid
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chanfold.llm import bin_completion, bpe_replay, spans, token_files, tokens

ODD_TEXTS = ["", " ", "  a  b ", "a\n b  c", "x'll don't 123456 ... $$$ \r\n\t\t  z", "　  q",
             "日本語テキスト 🙂🙂 é \x85 a\x1c b", "a \n b  \n", "<|endoftext|> <|startoftext|> x", "a\x00b \x00 c",
             "aaaaaaaaaaaaaaa" * 50, "q ́a ́́ e", "word,. word!? Word:;", "#2 # 2", "x" * 70 + "."]
DOCS = "doc_id long, text string, start string, ids int, length double, piece string"


def random_texts(n=300, seed=1):
    rng = random.Random(seed)
    alphabet = list("ab e's  \n\t1２é́日🙂'!$ \x1c\x85lL.,")
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(n)]


def library(name):
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    return tok


@pytest.fixture(scope="module")
def docs():
    words = "the and of Erthand, thstion. Ré ouble\nting 12 #"
    rng = random.Random(4)
    long = " ".join(rng.choice(words.split(" ")) for _ in range(6000))
    rows = [(5, "b text", "s", 1, 1.0, "p"), (5, "a text", "s", None, None, None), (5, "a text", "s", 1, 1.0, "p"),
            (None, "no id", None, 1, 1.0, "p"), (2, None, "s", 1, 1.0, "p"), (3, "", "s", 1, 1.0, "p"),
            (-4, long, "s", 1, 1.0, "p")]
    return rows + [(100 + i, t, "s", i, 0.5, "p") for i, t in enumerate(ODD_TEXTS)]


def ordered(rows):
    return sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_librarys_ids(name, monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_BYTES", 20_000)   # the table is emptied again and again
    monkeypatch.setattr(tokens, "GROUP_BYTES", 2000)
    monkeypatch.setattr(tokens, "MAX_PIECE_BYTES", 12)
    texts = ODD_TEXTS + random_texts() + [" ".join(random_texts(60, 8)), "u" * 9000, "é" * 5000 + " a"]
    got = list(tokens.documents_ids(tokens.library_encoder(P.path(name)), texts, None))
    want = library(name).encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_pieces_keep_every_character():
    texts = ODD_TEXTS + random_texts(100, 9)
    own = [t.encode() for t in texts]
    data, starts = spans.joined(np.cumsum([0, *map(len, own)]), np.frombuffer(b"".join(own), np.uint8), 0xFF, 2)
    at, lens = tokens.pieces(data, starts)
    cuts = np.searchsorted(at, starts)
    for k, t in enumerate(own):
        some = range(cuts[k], cuts[k + 1])
        assert b"".join(data[at[i]:at[i] + lens[i]].tobytes() for i in some) == t
    long = " ".join(texts).encode() * 3
    assert b"".join(p.tobytes() for p in tokens.segments(np.frombuffer(long, np.uint8), 300)) == long


def test_ids_of_a_long_text():
    text = "the word, " * 2_000_000
    (ids,) = tokens.documents_ids(tokens.library_encoder(P.path("byte_bpe_50k.json")), [text], 2)
    own = library("byte_bpe_50k.json").encode("the word, the word, ", add_special_tokens=False).ids
    assert len(ids) == 6_000_002 and ids[:3].tolist() == own[:3] and ids[3:6].tolist() == own[3:6]
    assert (ids[3:-2].reshape(-1, 3) == ids[3:6]).all()


def test_token_files(spark, docs):
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    manifest = token_files.write(df, P.path("word_bpe_49k.json"), seq_len=32)
    got = sorted(map(tuple, token_files.read_documents(manifest)
                     .select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    tok, start, want, stream = library("word_bpe_49k.json"), 0, [], []
    for doc_id, text in ordered(docs):
        ids = tok.encode(text, add_special_tokens=False).ids + [2]
        want.append((start, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        stream += ids
    assert [g[:1] + g[2:] for g in got] == [w[:1] + w[2:] for w in want]
    assert [g[1] for g in got] == [w[1] for w in want]
    read = []
    for r in manifest.orderBy("shard").collect():
        f = token_files.TokenFile(r["path"])
        assert len(f) == r["n_sequences"] and all(len(f.sequence(i)) == 32 for i in range(len(f)))
        real = [f.sequence(i)[j] for i in range(len(f)) for j in range(32) if f.mask(i)[j].as_py()]
        assert r["start"] == len(read) and len(real) == r["n_tokens"]
        assert not f.sequence(0).flags.owndata and not f.sequence(0).flags.writeable
        read += real
    assert read == stream


def test_a_shared_table_is_of_one_run_and_of_whole_tasks():
    path, texts = P.path("word_bpe_49k.json"), ODD_TEXTS + random_texts(50, 5)
    want = [e.ids for e in library("word_bpe_49k.json").encode_batch(texts, add_special_tokens=False)]
    for run, known in [("a", False), ("a", True), ("b", False), ("a", False)]:
        with tokens.shared_encoder(path, run) as encoder:
            assert bool(len(encoder.book)) == known
            assert [g.tolist() for g in tokens.documents_ids(encoder, texts, None)] == want
    with pytest.raises(ValueError), tokens.shared_encoder(path, "a") as encoder:
        raise ValueError("a failed task")
    with tokens.shared_encoder(path, "a") as encoder:
        assert not len(encoder.book)


def test_tasks_of_a_write_share_their_table(spark, tmp_path, monkeypatch):
    shared, folder = tokens.shared_encoder, str(tmp_path)

    @contextlib.contextmanager
    def watched(path, run):
        with shared(path, run) as encoder:
            known = len(encoder.book)
            yield encoder
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{os.getpid()} {len(encoder.book) - known}")

    monkeypatch.setattr(token_files, "shared_encoder", watched)
    words = [f" w{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}" for i in range(100)]
    df = spark.range(640).select(F.col("id").alias("doc_id"), F.lit("".join(words)).alias("text"))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        manifest = token_files.write(df, P.path("word_bpe_49k.json"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    new = collections.defaultdict(list)
    for f in tmp_path.iterdir():
        worker, n = map(int, f.read_text().split())
        new[worker].append(n)
    assert sum(map(len, new.values())) >= 48 and max(map(len, new.values())) > 1
    assert 100 in (known := {sum(own) for own in new.values()})
    assert known <= {0, 100}                             # each word is new once to a worker
    ids = library("word_bpe_49k.json").encode("".join(words), add_special_tokens=False).ids + [2]
    got = token_files.read_documents(manifest).groupBy("n_tokens", "ids_crc32").count().collect()
    assert [tuple(r) for r in got] == [(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), 640)]


def test_token_files_of_an_empty_table(spark):
    manifest = token_files.write(spark.createDataFrame([], DOCS), P.path("word_bpe_49k.json"))
    assert manifest.count() == 0 and token_files.read_documents(manifest).count() == 0


def held(solution):
    out = collections.Counter()
    for filling, n in solution:
        for size, copies in filling:
            out[size] += copies * n
    return dict(out)


def optimum(sizes, capacity):
    """Fewest bins, by trying every assignment."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                go(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1:])
        go(i + 1, bins + [sizes[i]])

    go(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(2)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = collections.Counter(sizes)
        solution = bin_completion.solve(counts, 30)
        assert held(solution) == dict(counts)
        assert all(sum(s * c for s, c in f) <= 30 for f, _ in solution)
        assert bin_completion.lower_bound(counts, 30) <= sum(n for _, n in solution) == optimum(sizes, 30)


def test_bin_completion_beats_best_fit():
    # Best fit decreasing needs one bin more than the optimum here.
    counts = {51: 3, 27: 3, 26: 3, 23: 3, 25: 6}
    solution = bin_completion.solve(counts, 101)
    best = bin_completion.best_fit(counts, 101)
    assert held(best) == held(solution) == counts
    assert sum(n for _, n in solution) <= sum(n for _, n in best)
    assert list(bin_completion.fillings({10: 1, 7: 1, 3: 1}, 10, 5)) == [(10,)]
    assert list(bin_completion.fillings({6: 1, 4: 2, 3: 3}, 11, 1)) == [(4, 4, 3), (6, 4)]
    assert bin_completion._dominates((8,), (5, 3)) and not bin_completion._dominates((5, 3), (8,))


def test_bin_completion_meets_the_bound_where_best_fit_does_not():
    rng, better = random.Random(12), 0
    for _ in range(8):
        sizes = [rng.randint(100, 450) for _ in range(300)]
        counts = collections.Counter(sizes)
        n = sum(k for _, k in bin_completion.solve(counts, 1024))
        first = sum(k for _, k in bin_completion.best_fit(counts, 1024))
        assert bin_completion.lower_bound(counts, 1024) <= n <= first
        better += n < first
    assert better >= 3


def places(rows, capacity):
    used = collections.defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in used.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(used)


def test_packing_of_whole_texts(spark, docs):
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    pieces = bin_completion.token_pieces(df, P.path("byte_bpe_50k.json"), capacity=64)
    packed = bin_completion.pack(pieces, capacity=64)
    rows = packed.collect()
    places(rows, 64)
    tok, whole = library("byte_bpe_50k.json"), collections.Counter()
    for doc_id, text in ordered(docs):
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 64 or 64
        for k, lo in enumerate([0, *range(first, len(ids), 64)]):
            hi = first if not k else lo + 64
            whole[doc_id, k, lo, hi - lo, ids[lo:hi].tobytes()] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == whole
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in bin_completion.sequences(packed).collect()}
    for r in rows:
        assert joined[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def test_pack_edge_cases(spark):
    df = spark.createDataFrame([(1, 10, "x"), (2, None, "x"), (3, 0, "y"), (4, 4, None), (5, 6, "z"), (6, 6, "z")],
                               "a int, length int, offset string")
    got = {r["a"]: r for r in bin_completion.pack(df, 10).collect()}
    assert got[2]["sequence_id"] is None and got[3]["offset"] is None and got[1]["offset"] == 0
    assert places([got[i] for i in (1, 4, 5, 6)], 10) == 3
    assert bin_completion.pack(df.limit(0), 10).count() == 0
    with pytest.raises(ValueError):
        bin_completion.pack(df, 5)


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_replay_is_tiktoken(ranks, monkeypatch):
    monkeypatch.setattr(bpe_replay, "GROUP_BYTES", 5000)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, table = bpe_replay.replay_encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts = ODD_TEXTS + random_texts(400, 3)
    got = list(tokens.documents_ids(encoder, texts, None))
    assert [g.tolist() for g in got] == [enc.encode_ordinary(t) for t in texts]
    assert all(table.decode(g).tobytes() == t.encode() for g, t in zip(got, texts))


def test_replay_where_a_merge_brings_up_a_lower_rank():
    # "bc" (5) makes "abc" (4) possible although 4 < 5; such words are merged again.
    letters = {bytes([i]): 100 + i for i in range(256)}
    table = bpe_replay.MergeTable(letters | {b"bc": 5, b"abc": 4, b"aa": 3, b"aaa": 6})
    words = [bytes(w) for n in range(1, 7) for w in itertools.product(b"abc", repeat=n)]
    enc = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=table.ranks, special_tokens={})
    ids, lens = bpe_replay.replay(words, table)
    got = np.split(ids, np.cumsum(lens)[:-1])
    assert [g.tolist() for g in got] == [enc.encode_ordinary(w.decode()) for w in words]


def test_replay_in_spark(spark, docs, ranks):
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    path = P.path("byte_bpe_50k.tiktoken")
    want = collections.Counter()
    for r in docs:
        ids = enc.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, bpe_replay.digest(df, path, P.PATTERN).collect())) == want
    encoded = bpe_replay.encode(df, path, P.PATTERN)
    data = collections.Counter((r["doc_id"], bytes(r["data"]).decode())
                               for r in bpe_replay.decode(encoded, path, P.PATTERN).collect())
    assert data == collections.Counter((r[0], r[1] or "") for r in docs)
    assert bpe_replay.digest(df.limit(0), path, P.PATTERN).count() == 0
