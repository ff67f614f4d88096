"""Remaining operator rules: projections (B*), joins (E12), K7 rules,
stage-3 presets (Q8), version stamps and audits (A15, A16)."""

import pytest
from pyspark.sql import functions as F

from gable.ml.features import select_feature_columns
from gable.operators import columns as C
from gable.operators import encode, joins, quality
from gable.operators.stage3 import Stage3
from gable.sources.files import stage_audit


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0, True)], "k int, s string, x_log double, b boolean")
    assert C.keep_numeric(df).columns == ["k", "x_log"]
    assert C.drop_by_affix(df, suffixes=["_log"]).columns == ["k", "s", "b"]
    assert C.drop_if_present(df, ["s", "absent"]).columns == ["k", "x_log", "b"]
    assert C.rename_if_present(df, {"s": "t", "absent": "z"}).columns == ["k", "t", "x_log", "b"]
    assert C.select_features(df, ["k", "absent"], strict=False).columns == ["k"]
    with pytest.raises(Exception):
        C.select_features(df, ["k", "absent"], strict=True)
    assert C.empty_like(df).count() == 0 and C.empty_like(df).columns == df.columns
    assert C.stamp_version(df, "__stage1_version", "1.0.0").first()["__stage1_version"] == "1.0.0"


def test_membership_filters_keep_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert {r.v for r in C.drop_values_keep_null(df, "v", ["a"]).collect()} == {None, "b"}
    assert {r.v for r in C.keep_values(df, "v", ["a", "b"]).collect()} == {"a", "b"}


def test_null_safe_lookup(spark):
    left = spark.createDataFrame([(None, 1), ("k", 2)], "key string, x int")
    right = spark.createDataFrame([(None, "n"), ("k", "m")], "key string, y string")
    plain = {r.x: r.y for r in joins.lookup_join(left, right, "key").collect()}
    safe = {r.x: r.y for r in joins.lookup_join(left, right, "key", null_safe=True).collect()}
    assert plain == {1: None, 2: "m"} and safe == {1: "n", 2: "m"}


def test_cap_and_remap(spark):
    df = spark.createDataFrame([(0.5,), (20.0,), (-1.0,), (5.0,)], "x double")
    assert [r.x for r in quality.cap_values(df, {"x": (1, 10)}).collect()] == [-1.0, -1.0, -1.0, 5.0]
    sub = spark.createDataFrame([("mixed building",), ("loft",), ("residence",), (None,), ("villa",)], "s string")
    out = [r.s for r in encode.remap_values(sub, "s", ["mixed building"],
                                            [{"loft": "apartment"}, {"residence": "house"}]).collect()]
    assert out == ["apartment", "house", None, "villa"]


def test_ordinal_default_and_missing_label(spark):
    df = spark.createDataFrame([("Gas",), (None,), ("Plasma",)], "h string")
    coded = [r.h for r in encode.ordinal_encode(df, "h", {"Missing": -1, "Gas": 3}).collect()]
    assert coded == [3, -1, None]
    cert = [r.h for r in encode.ordinal_encode(df, "h", {"Gas": 1}, missing_label=None, default=-1).collect()]
    assert cert == [1, -1, -1]


def test_feature_column_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, "s", 5.0, 6.0, "u")],
                               "price double, area double, area_log double, locality_te_price double, "
                               "name string, price_log double, ratio_to_x double, url string")
    _, tree = select_feature_columns(df, "price", "xgb")
    _, lin = select_feature_columns(df, "price", "linear")
    assert tree == ["area", "locality_te_price"] and lin == ["area", "area_log"]
    with pytest.raises(ValueError, match="not found"):
        select_feature_columns(df.drop("price"), "price")
    with pytest.raises(ValueError, match="Unknown model_type"):
        select_feature_columns(df, "price", "svm")


def test_stage3_presets(spark):
    rows = [("H", 100.0, -1.0, 2000.0, "p1", "l1", 1.0), ("A", 200.0, 50.0, None, "p1", "l2", 1.0),
            ("H", 300.0, 70.0, 2500.0, "p2", "l1", None)]
    df = spark.createDataFrame(rows, "property_type string, price double, area double, "
                                     "province_benchmark_m2 double, postal_code string, locality string, rooms double")
    training = Stage3.preset("training", te_cols=("property_type", "postal_code", "locality"))
    m = training.fit(df)
    assert "area_log" in m.medians                     # log median fitted (training preset)
    out = m.transform(df).collect()
    assert any(r.province_benchmark_m2 is None for r in out)   # benchmark columns stay raw
    assert all(r.area_log is not None for r in out)
    fitter = Stage3.preset("fitter", te_cols=("property_type", "postal_code", "locality"))
    assert all(r.province_benchmark_m2 is not None for r in fitter.fit(df).transform(df).collect())
    with pytest.raises(KeyError):
        Stage3.preset("fitter").fit(df.drop("locality"))
    oneshot = Stage3.preset("oneshot", te_cols=("property_type",)).fit_transform(df).collect()
    assert {r.postal_price_mean for r in oneshot if r.postal_code == "p1"} == {150.0}


def test_stage_audit(spark):
    a = spark.range(5)
    b = a.where("id > 2").withColumn("x", F.lit(1))
    got = {r.stage: (r.n_rows, r.n_cols) for r in stage_audit({"a": a, "b": b}).collect()}
    assert got == {"a": (5, 1), "b": (2, 2)}
