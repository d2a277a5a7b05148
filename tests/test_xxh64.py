import random

import pytest
import xxhash
from pyspark.sql import functions as F

from feedlens.functions.xxh64 import unsigned_mod, xxh64, xxh64_bucket

EDGE = [0, 1, -1, 2, 255, 256, 2**31 - 1, 2**31, 2**32 - 1, 2**32, 2**63 - 1, -2**63, -2**31]


def ids():
    rng = random.Random(7)
    return EDGE + [rng.randrange(-2**63, 2**63) for _ in range(6000)] + [rng.randrange(2**32) for _ in range(4000)]


@pytest.mark.parametrize("width, seed", [(8, 0), (4, 0), (8, 42), (4, 2**63 + 11)])
def test_equals_the_published_hash(spark, width, seed):
    keys = ids()
    df = spark.createDataFrame([(k,) for k in keys], "user_id long")
    got = {r.user_id: (r.h % 2**64, r.b) for r in df.withColumn("h", xxh64("user_id", width, seed)).withColumn("b", unsigned_mod("h", 50)).collect()}
    for k in keys:
        want = xxhash.xxh64((k % 2**(8 * width)).to_bytes(width, "little"), seed).intdigest()
        assert got[k] == (want, want % 50), k


def test_null_keys_other_columns_and_plan(spark):
    df = spark.createDataFrame([(None, "a"), (5, "b")], "user_id int, h string")
    rows = df.withColumn("bucket", xxh64_bucket("user_id", 7, 4)).collect()
    assert [r.h for r in rows] == ["a", "b"] and rows[0].bucket is None
    assert rows[1].bucket == xxhash.xxh64((5).to_bytes(4, "little"), 0).intdigest() % 7
    hashed = spark.range(10).withColumn("bucket", xxh64_bucket("id", 50))
    twice = hashed.join(hashed.groupBy("bucket").count(), "bucket").filter("bucket > 3")     # the optimizer copies the column
    plan = twice._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and len(plan) < 300_000
    with pytest.raises(ValueError):
        xxh64("user_id", 2)


def test_large_table_spreads_evenly(spark):
    counts = [r["count"] for r in spark.range(100_000).groupBy(xxh64_bucket(F.col("id"), 50).alias("bucket")).count().collect()]
    assert len(counts) == 50 and min(counts) > 1700 and max(counts) < 2300
