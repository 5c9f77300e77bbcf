"""The curve key is computed a batch at a time."""

from pyspark.sql import functions as F

from footmark.functions.curve import hilbert_key


def test_curve_key_is_no_lambda_on_each_row(spark):
    plan = spark.range(1).select(hilbert_key(F.col("id") * 1.0, F.col("id") * 1.0).alias("k"))._jdf.queryExecution().toString()
    assert "lambda" not in plan and "ArrowEvalPython" in plan
