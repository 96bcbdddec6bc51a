import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratecraft.functions import compound, compound_over, growth_factor, real_rate


def test_constant_rate_compounds_geometrically(spark):
    r = 0.8
    df = spark.createDataFrame([(m, r) for m in range(12)], "m int, r double")
    got = df.agg(compound("r").alias("c")).first().c
    assert got == pytest.approx(((1 + r / 100) ** 12 - 1) * 100, rel=1e-12)


def test_equal_rates_give_zero_real_rate(spark):
    df = spark.createDataFrame([(0.5, 0.5), (-0.3, -0.3), (12.0, 12.0)], "n double, p double")
    vals = [row.x for row in df.select(real_rate("n", "p").alias("x")).collect()]
    assert all(abs(v) < 1e-12 for v in vals)


def test_fisher_relation(spark):
    df = spark.createDataFrame([(1.0, 0.5)], "n double, p double")
    got = df.select(real_rate("n", "p").alias("x")).first().x
    assert got == pytest.approx((1.01 / 1.005 - 1) * 100, rel=1e-12)


def test_total_loss_is_null_not_a_short_sum(spark):
    # A factor <= 0 has no logarithm: the result is NULL, not the other rows' product.
    df = spark.createDataFrame([(1, 1.0), (1, -100.0), (1, 2.0), (2, 1.0)], "g int, r double")
    out = {row.g: row.c for row in df.groupBy("g").agg(compound("r").alias("c")).collect()}
    assert out[1] is None
    assert out[2] == pytest.approx(1.0, rel=1e-12)


def test_inflation_of_minus_100_gives_null_real_rate(spark):
    df = spark.createDataFrame([(1.0, -100.0)], "n double, p double")
    assert df.select(real_rate("n", "p").alias("x")).first().x is None


def test_compound_over_window_matches_product(spark):
    rows = [(k, m, 0.1 * (m + 1) + k) for k in range(3) for m in range(14)]
    df = spark.createDataFrame(rows, "k int, m int, r double")
    w = Window.partitionBy("k").orderBy("m").rowsBetween(-11, 0)
    out = df.select("k", "m", compound_over("r", w).alias("acc")).collect()
    for row in out:
        lo = max(0, row.m - 11)
        prod = math.prod(1 + (0.1 * (i + 1) + row.k) / 100 for i in range(lo, row.m + 1))
        assert row.acc == pytest.approx((prod - 1) * 100, rel=1e-9)


def test_growth_factor_casts_decimal(spark):
    df = spark.createDataFrame([("0.04320000",)], "v string").select(
        F.col("v").cast("decimal(18,8)").alias("v")
    )
    assert df.select(growth_factor("v").alias("f")).first().f == pytest.approx(1.000432)
