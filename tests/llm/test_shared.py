import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import shared as S


def test_lookup_equals_a_left_join(spark, monkeypatch):
    left = spark.createDataFrame([("a", 1, k) for k in range(50)] + [("b", 1, k) for k in range(3)] + [(None, 1, 7), ("c", None, 8), ("c", 2, 9), ("d", 3, 1)], "x string, y int, v int")
    right = spark.createDataFrame([("a", 1, "A"), ("b", 1, None), ("c", 2, "C"), (None, 1, "null")], "x string, y int, w string")
    want = sorted(map(str, left.join(right, ["x", "y"], "left").collect()))
    for common, keys in ((1000, 1000), (10, 1000), (0, 1000)):
        monkeypatch.setattr(S, "COMMON", common)
        monkeypatch.setattr(S, "KEYS", keys)
        out = S.looked_up(left, right, ["x", "y"])
        assert out.columns == ["x", "y", "v", "w"] and sorted(map(str, out.collect())) == want
    assert S.looked_up(left.limit(0), right, ["x", "y"]).count() == 0


def test_sieve_keeps_all_keys(spark):
    wanted = spark.range(0, 100_000, 7).select(F.col("id").alias("k"))
    rows = spark.range(100_000).withColumn("there", S.sieve(wanted, "k")(F.col("id")))
    assert rows.filter("id % 7 = 0 and not there").count() == 0
    assert rows.filter("id % 7 <> 0 and there").count() < 20_000
    assert spark.range(10).filter(S.sieve(wanted.limit(0), "k")(F.col("id"))).count() == 0


class _Cluster:
    class conf:
        get = staticmethod(lambda *_: None)

    class sparkContext:
        master, applicationId = "spark://host:7077", "app"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.shared_dir(_Cluster)


def test_shuffles_go_with_the_table_that_they_made(spark):
    def shuffles():
        return {str(b) for b in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if str(b).startswith("shuffle_")}

    before, set_ = shuffles(), spark.conf.get(S.CLEANUP)
    out = S.written(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count())
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(S.CLEANUP) == set_ and out.count() == 10


def test_workers_get_small_batches(spark):
    spark.conf.unset(S.BATCH_BYTES)
    S.ship(spark)
    rows = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), F.lit(8000)).alias("text"))

    @F.arrow_udf("bigint")
    def size(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts), pa.int64())

    assert rows.select(size("text").alias("n")).agg(F.max("n")).first()[0] < 8_000_000
    spark.conf.set(S.BATCH_BYTES, "16m")
    S.ship(spark)
    assert spark.conf.get(S.BATCH_BYTES) == "16m"  # a session's own value stays
    spark.conf.set(S.BATCH_BYTES, S.AT_ONCE)
