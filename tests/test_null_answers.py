"""NULL values never decide a metric, a minimum, a penalty or a lookup."""

import pytest
from pyspark.sql import functions as F

from gable.operators import encode, joins, metrics


def test_metrics_count_scored_rows_only(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 0.0), (100.0, None), (None, 3.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert (r.n, r.mae) == (2, 1.5) and r.r2 == pytest.approx(1 - 5 / 0.5)


def test_arg_min_skips_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.5), ("c", 0.1)], "feature string, importance double")
    assert tuple(metrics.arg_min(df, "importance", "feature").first()) == ("c", 0.1)


def test_penalty_of_a_missing_score_is_null(spark):
    df = spark.createDataFrame([(None, 0.9), (0.9, 0.5)], "t double, v double")
    a, b = [r[0] for r in df.select(metrics.gap_penalty("t", "v")).collect()]
    assert a is None and b > 0


def test_lookup_prefers_a_real_value(spark):
    df = spark.createDataFrame([("x", "x2", None), ("x", "x3", 5.0)], "a string, b string, v double")
    got = joins.two_name_lookup(df, "a", "b", ["v"], key="name")
    assert got.where(F.col("name") == "x").first().v == 5.0


def test_strict_numeric_strings_fail_on_malformed_text(spark):
    df = spark.createDataFrame([("12 m",), ("nan",), (None,), ("x9",)], "v string")
    assert [r.v for r in encode.clean_numeric_strings(df, ["v"]).collect()] == [12.0, None, None, None]
    with pytest.raises(Exception, match="not a number"):
        encode.clean_numeric_strings(df, ["v"], strict=True).collect()
    good = encode.clean_numeric_strings(df.where("v is null or v != 'x9'"), ["v"], strict=True)
    assert [r.v for r in good.collect()] == [12.0, None, None]
