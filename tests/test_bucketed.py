"""Tables in buckets of a key: joined and grouped by it without an exchange."""
import re
import uuid

from pyspark.sql import functions as F

from chanfold.operators import profile
from chanfold.plans import registry
from chanfold.plans.layers import materialize_bucketed
from conftest import SF_SMALL, rows


SCHEMA = "key bigint, `odd name` string"


def _exchanges(df):
    """What the exchanges of the plan hash by."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"Exchange (\w+)\(([^)]*)", plan)


def test_crosstab_has_no_exchange_by_product(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (registry._crosstab(spark, SF_SMALL), profile.infer_code_mapping(registry._crosstab(spark, SF_SMALL))):
            hashed = [by for kind, by in _exchanges(query) if kind == "hashpartitioning"]
            assert hashed and not any("key#" in by for by in hashed), hashed
        plain = profile.category_crosstab(registry.ecomm_lines(spark, SF_SMALL), "catCode", "article",
                                          registry._app_labelled(spark, SF_SMALL), "category_clean", "productId")
        assert any("key#" in by for kind, by in _exchanges(plain))
        assert rows(plain) == rows(registry._crosstab(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_written_once_found_again_and_empty(spark):
    built, fp = [], uuid.uuid4().hex

    def build():
        built.append(1)
        return spark.range(100).select((F.col("id") % 9).alias("key"), F.col("id").cast("string").alias("odd name"))

    first = materialize_bucketed(spark, build, "again", fp, "key", SCHEMA)
    assert rows(first) == rows(build()) and first.columns == ["key", "odd name"]
    spark.sql(f"DROP TABLE {first._jdf.queryExecution().analyzed().collectLeaves().apply(0).catalogTable().get().identifier().table()}")
    assert rows(materialize_bucketed(spark, build, "again", fp, "key", SCHEMA)) == rows(build())
    assert len(built) == 3                              # once by the layer, twice by this test
    none = materialize_bucketed(spark, build().where("false"), "none", fp, "key", SCHEMA)
    assert none.count() == 0 and none.columns == ["key", "odd name"]
