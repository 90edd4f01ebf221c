from pyspark.sql import functions as F

from chanfold.operators import kpis
from chanfold.plans.layers import Layers
from chanfold.streaming.incremental_kpis import _versions, read_latest_cube, start_cube_refresh
from conftest import SF_SMALL, rows


def test_incremental_cube_matches_batch(spark, tmpdir_path):
    fact = Layers(spark, SF_SMALL).fact_eur()
    src, cube_dir, ckpt = (f"{tmpdir_path}/{x}" for x in ("silver", "cube", "ckpt"))
    # two arrivals: first two channels, then the rest
    fact.filter(F.col("channel").isin("retail", "ecomm")).write.parquet(f"{src}/b1")
    q = start_cube_refresh(spark, f"{src}/*", cube_dir, ckpt)
    q.awaitTermination()
    fact.filter(~F.col("channel").isin("retail", "ecomm")).write.parquet(f"{src}/b2")
    q = start_cube_refresh(spark, f"{src}/*", cube_dir, ckpt)
    q.awaitTermination()
    cube = read_latest_cube(spark, cube_dir)
    assert 1 <= len(_versions(spark, cube_dir)) <= 2
    cut = ["country", "channel"]

    def r6(rs):
        return [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rs]
    assert r6(rows(kpis.rollup_cut(cube, cut))) == r6(rows(kpis.build_kpi_table(fact, cut)))
