import numpy as np
from pyspark.sql import functions as F

from chanfold.operators import profile as prof
from chanfold.plans.layers import Layers
from conftest import SF_SMALL


def test_profile_distinct_matches_brute_force(spark):
    fact = Layers(spark, SF_SMALL).fact()
    cols = ["country", "year_month", "member", "order_id"]
    got = {(r["column_name"], r["value_rank"]): (r["value"], r["n_distinct"])
           for r in prof.profile_distinct(fact, cols, n=5).collect()}
    pdf = fact.select(*cols).toPandas()
    for c in cols:
        vals = pdf[c].astype(object).where(pdf[c].notna(), None)
        as_text = {None if v is None else (str(v).lower() if isinstance(v, (bool, np.bool_)) else str(v))
                   for v in vals}
        ordered = sorted(as_text, key=lambda v: (v is not None, v or ""))[:5]
        for i, v in enumerate(ordered, 1):
            assert got[(c, i)] == (v, len(as_text))


def test_describe_quantiles_within_rank_error(spark):
    fact = Layers(spark, SF_SMALL).fact_eur()
    q = {r["column_name"]: r for r in prof.describe_quantiles(fact, ["revenue_eur"]).collect()}
    vals = np.sort(fact.select("revenue_eur").dropna().toPandas()["revenue_eur"].to_numpy())
    n = len(vals)
    for p in (25, 50, 75):
        v = q["revenue_eur"][f"p{p}"]
        below, upto = np.searchsorted(vals, v, side="left"), np.searchsorted(vals, v, side="right")
        target, err = p / 100 * n, n / 10_000 + 2
        assert below - err <= target <= upto + err


def test_describe_numeric_exact(spark):
    fact = Layers(spark, SF_SMALL).fact_eur()
    r = {x["column_name"]: x for x in prof.describe_numeric(fact, ["qty_sold"]).collect()}["qty_sold"]
    s = fact.select("qty_sold").toPandas()["qty_sold"]
    assert r["count"] == s.count() and r["min"] == s.min() and r["max"] == s.max()
    assert abs(r["mean"] - s.mean()) < 1e-9 and abs(r["std"] - s.std()) < 1e-9


def test_crosstab_matches_row_level_join(spark):
    coded = spark.createDataFrame([(1, "10"), (1, "10"), (2, "11"), (2, "12"), (3, "99")],
                                  "catCode bigint, article string")
    labelled = spark.createDataFrame([(10, "Running"), (10, "Running"), (11, "Outdoor"),
                                      (12, "Running")], "productId bigint, label string")
    ct = {(r["code"], r["label"]): r["count"]
          for r in prof.category_crosstab(coded, "catCode", "article",
                                          labelled, "label", "productId").collect()}
    assert ct == {(1, "Running"): 2, (2, "Outdoor"): 1, (2, "Running"): 1}
    inf = {r["code"]: (r["share"], r["n_matched"]) for r in prof.infer_code_mapping(
        prof.category_crosstab(coded, "catCode", "article", labelled, "label", "productId")).collect()}
    assert inf[1] == (1.0, 2) and inf[2] == (0.5, 2)


def test_id_overlap_counts_null_once(spark):
    a = spark.createDataFrame([("1",), ("2",), (None,), ("2",)], "k string")
    b = spark.createDataFrame([(2,), (None,), (3,)], "k bigint")
    assert prof.id_overlap(a, "k", b, "k").first()["overlap"] == 2


def test_null_counts_and_sample(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {r[0]: r[1] for r in prof.null_counts(df).collect()} == {"a": 1, "b": 2}
    assert [tuple(r) for r in prof.sample_rows(df, 2).collect()] == [(None, None), (1, None)]
    assert prof.value_counts(df, "b").filter(F.col("value").isNull()).first()["n"] == 2


def test_exact_quantiles_match_brute_force(spark):
    import math
    fact = Layers(spark, SF_SMALL).fact_eur()
    out = {r["column_name"]: r for r in prof.exact_quantiles(spark, fact, ["revenue_eur", "qty_sold"]).collect()}
    for c in ["revenue_eur", "qty_sold"]:
        vals = sorted(v for v in fact.select(c).toPandas()[c].dropna().tolist())
        for p in (0.25, 0.5, 0.75):
            k = max(1, math.ceil(p * len(vals)))
            assert out[c][f"p{int(p * 100)}"] == float(vals[k - 1])


def test_code_mapping_ties_do_not_depend_on_order(spark):
    rows_ = [("1", "a", 3), ("1", "b", 3), ("1", "c", 1), ("2", None, 2), ("2", "z", 2), ("3", "x", 1)]
    for order in (rows_, rows_[::-1]):
        df = spark.createDataFrame(order, "code string, label string, count long").coalesce(1)
        got = {r["code"]: r["inferred_label"] for r in prof.infer_code_mapping(df).collect()}
        assert got == {"1": "b", "2": "z", "3": "x"}
