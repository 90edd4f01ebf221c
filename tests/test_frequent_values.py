"""Most frequent values by sketch and exact counts, against plain counting."""
import random
from collections import Counter

from pyspark.sql import functions as F

from chanfold.operators import profile
from conftest import rows


def _want(data, columns, n):
    out = []
    for i, c in enumerate(columns):
        counted = Counter(None if r[i] is None else str(r[i]) for r in data)
        top = sorted(counted.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:n]
        out += [(c, v, k, m) for k, (v, m) in enumerate(top, 1)]
    return sorted(out, key=repr)


def _data(rng, size):
    hot = lambda i: rng.choice(["hot", "hot", None, "", "warm", f"cold{i}"])
    return [(hot(i), i, rng.randrange(5), "a" * 3000 + str(i % 7)) for i in range(size)]


COLUMNS = ["skewed", "unique", "few", "long"]
SCHEMA = "skewed string, unique int, few int, long string"


def test_counts_are_exact_for_any_spread(spark):
    data = _data(random.Random(5), 5000)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    for n in (1, 4, 15):
        assert rows(profile.frequent_values(df, COLUMNS, n, tracked=128, candidates=16)) == _want(data, COLUMNS, n)


def test_values_that_stand_out_need_no_count_of_the_rest(spark):
    data = _data(random.Random(6), 20_000)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    counts, left = profile.frequent_counts(df, COLUMNS, 4, tracked=128, candidates=16)
    assert left == ["unique"]                          # nothing stands out there
    assert counts.count() < 100                        # of more than 20,000 distinct values
    # Asked for more values than stand out, the column is counted whole.
    assert set(profile.frequent_counts(df, COLUMNS, 6, tracked=128, candidates=16)[1]) == {"unique", "skewed"}


def test_a_full_list_of_candidates_is_not_taken_for_all(spark):
    # 40 values of 50 to 89 rows; 8 candidates cannot decide the 10 most frequent.
    data = [(v,) for v in range(40) for _ in range(50 + v)]
    df = spark.createDataFrame(data, "v int").repartition(5)
    assert profile.frequent_counts(df, ["v"], 10, tracked=1024, candidates=8)[1] == ["v"]
    assert rows(profile.frequent_values(df, ["v"], 10, tracked=1024, candidates=8)) == _want(data, ["v"], 10)


def test_ties_nulls_empty_tables_and_odd_names(spark):
    data = [("b",), ("a",), (None,), ("b",), ("a",), (None,), ("",), ("",)]
    df = spark.createDataFrame(data, "`odd name.x` string")
    got = profile.frequent_values(df, ["odd name.x"], 3)
    assert [(r["value"], r["n"]) for r in got.orderBy("value_rank").collect()] == [(None, 2), ("", 2), ("a", 2)]
    assert profile.frequent_values(df.where(F.lit(False)), ["odd name.x"], 3).count() == 0
