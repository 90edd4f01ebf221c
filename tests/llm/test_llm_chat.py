"""Chat formatting against a version in plain Python."""
import collections
import hashlib

from chanfold.llm import chat_format

TURNS = "conv_id long, turn long, role string, text string, seg string, is_target int"
ROWS = [(1, 0, "system", "be\\ [nice] <s>[INST] </s>", "x", 1), (1, 1, "user", "</s>[INST] ok [/INST]", "x", 1),
        (1, 2, "assistant", " a\\[b]\n </s>", None, None), (1, 3, "user", "", "x", 1), (1, 4, "assistant", None, "x", 1),
        (1, 5, "user", "after", "x", 1), (2, 0, "user", "alone", "x", 1), (3, 0, "assistant", "x" * 50_000, "x", 1),
        (4, None, None, "no turn", "x", 1), (4, 2, "tool] \n", "odd role", "x", 1), (4, 2, "tool] \n", "odd role", "x", 1),
        (4, 2, "Assistant", "not it", "x", 1), (None, 0, "assistant", "no id é🙂", "x", 1),
        (7, 1, "assistant", "b", "x", 1), (7, 1, "assistant", "a", "x", 1)]


def plain(rows):
    convs = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        convs[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    out = {}
    for c, own in convs.items():
        own = [(r.decode(), x.decode()) for _, _, r, x in sorted(own)]
        loss = "".join(x for r, x in own if r == "assistant")
        out[c] = (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digest(spark):
    df = spark.createDataFrame(ROWS, TURNS).repartition(3)
    got = {r["conv_id"]: r for r in chat_format.digest(chat_format.segments(df)).collect()}
    want = plain(ROWS)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want
    assert got[2]["n_examples"] == 0 and got[1]["n_examples"] == 2
    assert chat_format.digest(chat_format.segments(df.limit(0))).count() == 0


def test_examples_are_prefixes_with_one_trainable_reply(spark):
    segs = chat_format.segments(spark.createDataFrame(ROWS, TURNS)).cache()
    full = {(r["conv_id"], r["seg"]): r for r in chat_format.materialize(segs).collect()}
    whole = collections.defaultdict(str)
    for r in segs.orderBy("conv_id", "seg").collect():
        whole[r["conv_id"]] += r["segment"]
    examples = chat_format.expand(segs).collect()
    assert {(e["conv_id"], e["seg"]) for e in examples} == set(full) and len(examples) == 6
    for e in examples:
        f = full[e["conv_id"], e["seg"]]
        assert f["formatted"] == whole[e["conv_id"]][:e["chars"]]
        assert f["formatted"][e["context_chars"]:] == e["target"]
        assert (e["loss_start"], e["loss_end"]) == (f["loss_start"], f["loss_end"])
        assert f["formatted"][:f["loss_start"]].endswith("[/INST] ") and f["formatted"][f["loss_end"]:] == " </s>"
    # No control string inside an escaped text.
    for r in segs.collect():
        body = r["segment"][r["body_start"]:r["body_start"] + r["body_chars"]]
        assert "<s>[" not in body and "</s>" not in body.replace("\\<", "") and "[INST]" not in body


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(ROWS, TURNS)
    plan = chat_format.digest(chat_format.segments(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_digest_reads_full_examples(spark):
    """Prefix and target are written out in ``expand``, and the digest reads replies from them alone."""
    segs = chat_format.segments(spark.createDataFrame(ROWS, TURNS))
    for e in chat_format.expand(segs).collect():
        assert len(e["formatted"]) == e["chars"] and e["formatted"][e["context_chars"]:] == e["target"]
        assert e["formatted"].count(" </s>") >= e["context_turns"] + 1
    plan = chat_format.digest(segs)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(segment" in plan and "formatted" in plan
