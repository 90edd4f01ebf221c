import math

import pytest

from pyspark.sql import functions as F

from chanfold.functions import (decode_flag, ieee_divide, month_from_int, month_from_slash,
                                month_from_spanish, month_from_timestamp, n_unique, recode,
                                recode_code)
from chanfold.specs import COUNTRY_NAME_TO_ISO2, ECOMM_CATCODE_TO_CATEGORY


def test_recode_passes_unmapped_and_null(spark):
    df = spark.createDataFrame([("Brazil",), ("Atlantis",), (None,)], "c string")
    out = [r[0] for r in df.select(recode("c", COUNTRY_NAME_TO_ISO2)).collect()]
    assert out == ["BR", "Atlantis", None]


def test_recode_code_numeric_and_unmapped(spark):
    df = spark.createDataFrame([(1,), (4,), (9,), (None,)], "c bigint")
    out = [r[0] for r in df.select(recode_code("c", ECOMM_CATCODE_TO_CATEGORY)).collect()]
    assert out == ["Running", "Originals", "9", None]


def test_flags_three_valued(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("?",), (None,)], "f string")
    retail = [r[0] for r in df.select(decode_flag("f", "Y", "N")).collect()]
    app = [r[0] for r in df.select(decode_flag("f", "Y", None)).collect()]
    assert retail == [True, False, None, None]
    assert app == [True, None, None, None]          # app: N is unknown, not false


def test_month_dialects(spark):
    df = spark.createDataFrame([("Abr-2025", 202503, "2025/03/04", "2025-03")],
                               "es string, i bigint, sl string, ts string")
    r = df.select(month_from_spanish("es"), month_from_int("i"), month_from_slash("sl"),
                  month_from_timestamp(F.to_timestamp("ts", "yyyy-MM"))).first()
    assert tuple(r) == ("2025-04", "2025-03", "2025-03/04", "2025-03")


def test_month_without_separator_is_null(spark):
    df = spark.createDataFrame([("Abr2025",), ("Xyz-2025",)], "m string")
    out = [r[0] for r in df.select(month_from_spanish("m")).collect()]
    assert out == [None, "2025-Xyz"]                 # unmapped month text passes through


def test_ieee_divide(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0), (-3.0, 0.0), (1.0, 4.0), (None, 1.0)],
                               "a double, b double")
    out = [r[0] for r in df.select(ieee_divide("a", "b")).collect()]
    assert math.isnan(out[0]) and out[1] == math.inf and out[2] == -math.inf
    assert out[3] == 0.25 and out[4] is None


def test_n_unique_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "o string")
    assert df.select(n_unique("o")).first()[0] == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_sums_lose_nothing(spark, ansi):
    from chanfold.functions.arith import money_sum, money_sum_or_zero
    groups = {"small": [4e-7] * 3, "large": [1e13] * 3, "mixed": [1e13, 0.25, 4e-7, -3.0], "nan": [1.0, float("nan")],
              "inf": [float("inf"), 1.0], "none": [None, None], "some": [None, 2.5], "ties": [0.1] * 10,
              "wide": [1e300, 1.0, -1e300], "cents": [190648.79665, -12.0078125, 2.5e-7, 1.0000004999]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, x double")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = {r["g"]: r for r in df.groupBy("g").agg(money_sum("x").alias("s"),
                                                     money_sum_or_zero("x").alias("z")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got["none"]["s"] is None and got["none"]["z"] == 0.0
    assert math.isnan(got["nan"]["s"]) and got["inf"]["s"] == math.inf
    for g in ("small", "large", "mixed", "some", "ties", "cents"):
        assert math.isclose(got[g]["s"], math.fsum(v for v in groups[g] if v is not None), rel_tol=1e-15), g
    assert abs(got["wide"]["s"] - 1.0) <= 1.0


def test_money_sum_does_not_depend_on_order(spark):
    import random

    from chanfold.functions.arith import money_sum
    rng = random.Random(1)
    vals = [round(rng.uniform(-1e5, 1e5), 2) for _ in range(2000)] + [rng.random() / 7 for _ in range(500)]
    sums = set()
    for seed in range(4):
        random.Random(seed).shuffle(vals)
        df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3 + seed)
        sums.add(df.agg(money_sum("x")).first()[0])
    assert len(sums) == 1 and math.isclose(sums.pop(), math.fsum(vals), rel_tol=1e-15)


def test_money_sums_are_the_nearest_double_whatever_the_partitioning(spark):
    import random
    from fractions import Fraction

    from chanfold.functions.arith import money_sum
    rng = random.Random(4)
    groups = {
        "cancel": [1e13, -1e13, 4e-7, 1e13 + 0.002, -1e13, 0.1] * 30,
        "sizes": [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-12, 20) for _ in range(400)],
        "minus": [-rng.random() * 1e6 for _ in range(200)],
        "edge": [2.0 ** 70, 2.0 ** 70 + 2.0 ** 40, -(2.0 ** 52), 2.0 ** 23, -(2.0 ** 23) - 0.5, 2.0 ** -43 + 2.0 ** -95, 1.0] * 5,
        "half": [2.0 ** 53, 1.0], "above_half": [2.0 ** 53, 1.0, 2.0 ** -60], "below_half": [2.0 ** 53, 1.0, -(2.0 ** -60)],
        "zero": [0.0, -0.0, 5.5, -5.5], "one": [rng.random()],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    seen = []
    for parts in (1, 2, 5, 9, 16):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g string, x double").repartition(parts)
        seen.append({r["g"]: r["s"] for r in df.groupBy("g").agg(money_sum("x").alias("s")).collect()})
    assert all(s == seen[0] for s in seen)
    for g, vs in groups.items():
        assert seen[0][g] == float(sum(map(Fraction, vs))), g
