import uuid

from pyspark.sql import functions as F

from segscore.session import ensure_checkpoint_dir
from segscore.sources import fixtures as fx
from segscore.streaming.score_stream import score_stream
from tests.conftest import SF


def test_stream_equals_batch(spark):
    feats = fx.CUSTOMER_FEATURES
    df = fx.customer_features(spark, SF).select("id", *feats)
    base = f"{ensure_checkpoint_dir(spark)}/t-stream-{uuid.uuid4().hex[:8]}"
    df.repartition(3).write.parquet(f"{base}/in")
    scorer = lambda d: d.select("id", (F.col("qty") / F.col("n_lines")).alias("score"))
    q = score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", feats, scorer)
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out/scored").drop("batch")
    exp = scorer(df)
    assert got.count() == exp.count() == 150
    assert got.exceptAll(exp).count() == 0
    assert spark.read.parquet(f"{base}/out/rejected").count() == 0


def test_feature_scan_is_pruned_and_preaggregated(spark):
    plan = fx.customer_features(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,l_returnflag:string>" in plan or \
        "l_shipdate" not in plan
    assert "c_name" not in plan and "o_orderdate" not in plan
