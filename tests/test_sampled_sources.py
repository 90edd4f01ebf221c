"""CSV typed by its first rows, JSON of mixed types, stored sketches."""
import itertools
import json
import random

import pytest
from pyspark.sql import Observation

from chanfold.operators import profile
from chanfold.sources import readers
from conftest import rows


def _csv(path, files):
    import os
    os.makedirs(path)
    for name, lines in files.items():
        with open(f"{path}/{name}", "w") as f:
            f.write("\n".join(["id,price,ok,note,empty", *lines]) + "\n")


def test_types_come_from_the_first_rows(spark, tmpdir_path):
    first = [f"{i},{i}.5,{'true' if i % 2 else 'False'},t{i}," for i in range(30)]
    late = ["x1,2.5,true,a,", "31,abc,maybe,b,", '32,3,true,"c, d",9']
    _csv(f"{tmpdir_path}/c", {"part-0.csv": first[:20], "part-1.csv": first[20:] + late})
    schema = readers.infer_csv_schema(spark, f"{tmpdir_path}/c", 30)
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "double", "boolean", "string", "string"]
    obs = Observation("misfits")
    df = readers.read_csv_sampled(spark, f"{tmpdir_path}/c", 30, obs)
    got = {r["note"]: r for r in df.collect()}
    assert len(got) == 33 and obs.get == {"rows": 33, "misfit_rows": 2}
    assert got["a"]["id"] is None and got["a"]["price"] == 2.5 and got["a"][readers.CORRUPT].startswith("x1,2.5")
    assert got["b"]["price"] is None and got["b"]["ok"] is None and got["b"]["id"] == 31
    assert got["c, d"][readers.CORRUPT] is None and got["c, d"]["empty"] == "9" and got["t3"]["ok"] is True
    # With the whole file as the sample nothing is a misfit.
    whole = readers.infer_csv_schema(spark, f"{tmpdir_path}/c", 10_000)
    assert [f.dataType.simpleString() for f in whole] == ["string", "string", "string", "string", "bigint"]


def test_csv_without_rows(spark, tmpdir_path):
    _csv(f"{tmpdir_path}/c", {"part-0.csv": []})
    assert {f.dataType.simpleString() for f in readers.infer_csv_schema(spark, f"{tmpdir_path}/c")} == {"string"}
    assert readers.read_csv_sampled(spark, f"{tmpdir_path}/c").count() == 0


def test_json_cells_of_mixed_types(spark, tmpdir_path):
    import os
    docs = {"a.json": [{"id": 1, "x": 1.5, "s": "t"}, {"id": "2", "x": "abc", "s": 7}, {"id": {"n": 3}, "x": None}, 5, None],
            "b.json": {"id": 4}, "c.json": []}
    os.makedirs(f"{tmpdir_path}/j")
    for name, doc in docs.items():
        with open(f"{tmpdir_path}/j/{name}", "w") as f:
            json.dump(doc, f)
    with open(f"{tmpdir_path}/j/d.json", "w") as f:
        f.write('[{"id": 9}')
    got = rows(readers.read_json_array_variant(spark, f"{tmpdir_path}/j", "id bigint, x double, s string"))
    want = [(1, 1.5, "t", []), (2, None, "7", ["x"]), (None, None, None, ["id"]), (None, None, None, ["*"]),
            (None, None, None, ["*"]), (None, None, None, ["*"]), (None, None, None, ["*"])]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [16, 4])          # with 4 bits sketches are samples and rule nothing out
def test_id_overlaps(spark, tmpdir_path, monkeypatch, bits):
    monkeypatch.setattr(profile, "SKETCH_BITS", bits)
    rng = random.Random(3)
    pick = lambda lo, hi: [rng.choice([None, *range(lo, hi)]) for _ in range(300)]
    data = {"a": {"x": pick(0, 100), "y": pick(500, 600)}, "b": {"x": pick(90, 200)}, "c": {"z": list(range(1000, 1300))}}
    frames = {s: (spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} bigint" for c in cols)).repartition(3),
                  list(cols)) for s, cols in data.items()}
    profile.id_sketches(frames).write.parquet(f"{tmpdir_path}/s{bits}")
    got = rows(profile.id_overlaps(frames, spark.read.parquet(f"{tmpdir_path}/s{bits}")))
    names = [(s, c) for s, cols in data.items() for c in cols]
    want = [(*p, *q, len(set(data[p[0]][p[1]]) & set(data[q[0]][q[1]])))
            for p, q in itertools.combinations(names, 2) if p[0] != q[0]]
    assert got == sorted(want, key=repr) and any(w[-1] == 0 for w in want) and any(w[-1] > 5 for w in want)


def test_quantiles_of_any_cut(spark):
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), rng.choice("xyz"), rng.choice([None, float("nan"), *[rng.gauss(0, 1)] * 8]),
             rng.randint(0, 9) if rng.random() < 0.6 else 5) for _ in range(6000)]
    df = spark.createDataFrame(data, "g string, h string, v double, n bigint").repartition(5)
    cells = profile.quantile_cells(df, ["g", "h"], ["v", "n"])
    for by in (["g"], ["h"], ["g", "h"]):
        out = profile.checked_quantiles(df, profile.quantiles_of_cut(cells, by), by, ["v", "n"]).collect()
        assert len(out) == 2 * 3 * len({tuple(r[{"g": 0, "h": 1}[c]] for c in by) for r in data})
        for r in out:
            own = sorted(x for d in data if all(d[{"g": 0, "h": 1}[c]] == r[c] for c in by)
                         for x in [d[2] if r["column_name"] == "v" else d[3]] if x is not None and x == x)
            want, lo, hi = r["p"] * len(own), sum(x < r["value"] for x in own), sum(x <= r["value"] for x in own)
            assert r["n"] == len(own) and r["rank_error"] == pytest.approx(max(lo - want, want - hi, 0) / len(own))
            assert r["rank_error"] <= profile.KLL_ERROR
    assert profile.quantiles_of_cut(profile.quantile_cells(df.limit(0), ["g"], ["v"]), ["g"]).count() == 0
