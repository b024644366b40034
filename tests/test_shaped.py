import math

from pyspark.sql import functions as F

from workload.tables import MOST, OFF_TIES, shaped

ODD = [
    0.0, -0.0, 1.0, -1.0, 10.0, 999.99995, 9.9999995, 99999995.0, 0.00005, -0.00005, 0.00015, 1.0000005, 1e-16, 1e-17, 5e-324,
    1e15, 1e22, 1e28, 1.7e308, 123456.75, -0.1234565, 2.5, float("inf"), float("-inf"), float("nan"), None]


def as_text(df, sigs, digits):
    """Seven digits by printf and places by Spark's own rounding."""
    return df.select(*[
        F.when(F.col(c).isNotNull(), F.format_string("%.6e", F.col(c) * OFF_TIES).cast("double")).alias(c) if c in sigs
        else F.round(F.col(c) * OFF_TIES, digits).alias(c) for c in df.columns])


def test_digits_without_text_are_those_of_text(spark):
    odd = spark.createDataFrame([(v,) for v in ODD], "v double")
    many = spark.range(20_000).select(((F.rand(1) - 0.5) * F.pow(F.lit(10.0), F.floor(F.rand(2) * 60 - 30))).alias("v"))
    ties = spark.range(20_000).select(((F.floor(F.rand(3) * 1e7) + 0.5) / OFF_TIES / F.pow(F.lit(10.0), F.floor(F.rand(4) * 12))).alias("v"))
    df = odd.union(many).union(ties).select(F.col("v").alias("s"), F.col("v").alias("r"))
    got = [str(r) for r in shaped(df, 4, ("s",)).collect()]
    assert got == [str(r) for r in as_text(df, ("s",), 4).collect()]


def text_evaluations(df):
    """Columns of the optimised plan whose only way to their digits is text."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("format_string"), plan.count("LOG10")


def test_text_is_the_exception(spark):
    """Printing every value took more time than the indicators themselves."""
    df = spark.createDataFrame([(1.5, 2.5, 3.5)], "a double, b double, c double")
    texts, logs = text_evaluations(shaped(df, 4, ("a", "b")))
    assert texts == logs == 2
    wide = df.select(*[F.col("a").alias(f"a{i}") for i in range(MOST + 1)])
    assert [math.isclose(v, 1.5) for v in shaped(wide, None, ("*",)).first()] == [True] * (MOST + 1)
