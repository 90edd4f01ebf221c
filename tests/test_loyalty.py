from chanfold.operators import loyalty


def test_uplift_reproduces_published_example(spark):
    # Published inputs: 553,504 member and 325,001 non-member orders, member
    # ticket 347.969546 -> about 7.95M at a 10 % share.
    cmp_ = spark.createDataFrame(
        [(True, 553504 * 347.969546, 1, 553504, 347.969546),
         (False, 1.0, 1, 325001, 359.45)],
        "member boolean, revenue_total double, num_lineas bigint, num_ordenes_unicas bigint, "
        "avg_revenue_por_orden double")
    r = loyalty.member_uplift(cmp_, share=0.10).first()
    assert round(r["uplift_ratio"], 2) == 1.70
    assert abs(r["potential_revenue"] - 7_951_209) < 1_000


def test_member_comparison_distinct_on_order_id(spark):
    fact = spark.createDataFrame(
        [("retail", "o1", True, "delivered", 10.0), ("ecomm", "o1", True, "returned", 5.0),
         ("retail", "o2", False, "delivered", None), ("retail", "o3", None, "delivered", 1.0),
         ("retail", "o4", True, "cancelled", 9.0)],
        "channel string, order_id string, member boolean, order_status string, revenue_eur double")
    out = {r["member"]: r for r in loyalty.member_comparison(fact).collect()}
    assert set(out) == {True, False}
    assert out[True]["num_ordenes_unicas"] == 1 and out[True]["num_lineas"] == 2
    assert out[True]["revenue_total"] == 15.0 and out[False]["revenue_total"] == 0.0


def test_approx_distinct_is_close(spark):
    from chanfold.plans.layers import Layers
    from conftest import SF_SMALL
    fact = Layers(spark, SF_SMALL).fact_eur()
    exact = {r["member"]: r["num_ordenes_unicas"] for r in loyalty.member_comparison(fact).collect()}
    approx = {r["member"]: r["num_ordenes_unicas"]
              for r in loyalty.member_comparison(fact, approx_distinct=True).collect()}
    assert all(abs(approx[k] - exact[k]) <= 0.05 * exact[k] + 2 for k in exact)
