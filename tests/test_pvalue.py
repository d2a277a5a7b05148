import math

import numpy as np
from pyspark.sql import functions as F

from feedlens.functions.pvalue import norm_two_sided, t_pvalue, t_two_sided


def _math3(spark):
    return spark.sparkContext._jvm.org.apache.commons.math3.distribution


def test_t_pvalues_match_commons_math3(spark):
    dist = _math3(spark)
    for df in (1.0, 2.5, 3.5, 10.0, 57.3, 400.0, 20000.0):
        for t in (0.01, 0.5, 1.0, 2.0, 3.7, 8.0):
            ref = 2.0 * dist.TDistribution(float(df)).cumulativeProbability(float(-t))
            got = t_two_sided([t], [df])[0]
            assert math.isclose(got, ref, rel_tol=1e-9, abs_tol=1e-15), (t, df, got, ref)
            assert t_two_sided([-t], [df])[0] == got


def test_tiny_t_tail_relative_accuracy(spark):
    dist = _math3(spark)
    ref = 2.0 * dist.TDistribution(30.0).cumulativeProbability(-12.0)
    got = t_two_sided([12.0], [30.0])[0]
    assert math.isclose(-math.log10(got), -math.log10(ref), rel_tol=1e-6)


def test_normal_tail():
    assert math.isclose(norm_two_sided([1.959963984540054])[0], 0.05, rel_tol=1e-12)
    assert norm_two_sided([0.0])[0] == 1.0
    assert np.isnan(norm_two_sided([float("nan")])[0])


def test_pvalue_udf_runs_in_spark_and_nulls_stay_null(spark):
    df = spark.createDataFrame([(2.0, 10.0), (None, 5.0), (1.0, None)], "t double, df double")
    got = [r[0] for r in df.select(t_pvalue(F.col("t"), F.col("df"))).collect()]
    assert math.isclose(got[0], 0.0733880348, rel_tol=1e-8)
    assert got[1] is None and got[2] is None


def test_t_pvalues_at_cluster_scale_df(spark):
    # Welch df grows with the number of users; the tail stays accurate at 1e8.
    dist = _math3(spark)
    for df in (1e5, 1e7, 1e8):
        for t in (0.5, 2.0, 5.0):
            ref = 2.0 * dist.TDistribution(float(df)).cumulativeProbability(float(-t))
            assert math.isclose(t_two_sided([t], [df])[0], ref, rel_tol=1e-7)
