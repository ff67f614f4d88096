"""Column expressions (C*, D*, B1) on hand-made rows."""

from pyspark.sql import functions as F

from gable.functions import codes, text


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_regex_group_null_on_no_match(spark):
    df = one_col(spark, ["https://x/en/detail/master-house/for-sale/1000/brussel/p1", "https://x/nothing", None])
    assert col_values(df, text.regex_group("x", r"/(\d{4})/")) == ["1000", None, None]
    assert col_values(df, text.regex_group("x", r"/\d{4}/([^/]+)/")) == ["brussel", None, None]
    # two 4-digit segments: the first wins
    df2 = one_col(spark, ["a/1000/b/2000/c"])
    assert col_values(df2, text.regex_group("x", r"/(\d{4})/")) == ["1000"]


def test_normalize_label_and_classify(spark):
    df = one_col(spark, ["Master-House", "  ground\tfloor ", "VILLA", None, "castle"])
    norm = col_values(df, text.normalize_label("x"))
    assert norm == ["master house", "ground floor", "villa", None, "castle"]
    groups = {"House": ["master house", "villa"], "Apartment": ["ground floor"]}
    assert col_values(df, text.classify("x", groups)) == ["House", "Apartment", "House", "Other", "Other"]


def test_yes_no(spark):
    df = one_col(spark, ["Yes", " no ", "YES", "maybe", None])
    assert col_values(df, text.yes_no("x")) == [1, 0, 1, None, None]


def test_to_number_and_clean_numeric(spark):
    df = one_col(spark, ["12", " 7.5 ", "1d", "abc", None, "-3e2", ".5"])
    assert col_values(df, text.to_number("x")) == [12.0, 7.5, None, None, None, -300.0, 0.5]
    df2 = one_col(spark, ["12 m", " 7.5m ", "None", "", "nan", None])
    assert col_values(df2, text.clean_numeric_string("x")) == [12.0, 7.5, None, None, None, None]


def test_vat_postal_coalesce(spark):
    df = one_col(spark, [": No", "No", "Yes", ":No"])
    assert col_values(df, text.normalize_vat("x")) == ["No", "No", "Yes", "No"]
    df2 = one_col(spark, ["0999", "1000", None, "0"])
    assert col_values(df2, text.int_key_string("x")) == ["999", "1000", None, None]
    df3 = spark.createDataFrame([("", "b"), ("a", "b"), (None, "b")], "a string, b string")
    assert col_values(df3, text.coalesce_blank("a", "b")) == ["b", "a", "b"]


def test_round_half_even(spark):
    df = one_col(spark, [0.5, 1.5, 2.5, 2.6], "double")
    assert col_values(df, text.round_half_even("x")) == [0.0, 2.0, 2.0, 3.0]


def test_codes(spark):
    df = one_col(spark, [1.0, 0.0, 2.0, None], "double")
    assert col_values(df, codes.binary_with_missing("x")) == [1, 0, -1, -1]
    df2 = one_col(spark, [-1.0, 3.0, None], "double")
    assert col_values(df2, codes.missing_flag("x")) == [1, 0, 0]
    assert col_values(df2, codes.sentinel_to_null("x")) == [None, 3.0, None]
    df3 = one_col(spark, [0.0, -2.0, 1.0, None], "double")
    out = col_values(df3, codes.log1p_positive("x"))
    assert out[0] is None and out[1] is None and abs(out[2] - 0.6931471805599453) < 1e-15 and out[3] is None


def test_lookup_unmapped_is_null_or_default(spark):
    df = one_col(spark, ["New", "Ruin", None])
    m = {"New": 4, "Missing": -1}
    assert col_values(df, codes.lookup("x", m)) == [4, None, None]
    assert col_values(df, codes.lookup("x", m, -1)) == [4, -1, -1]


def test_range_flag_and_cap(spark):
    df = one_col(spark, [14.0, 15.0, 1000.0, 1001.0, -1.0, None], "double")
    assert col_values(df, codes.out_of_range_flag("x", 15, 1000)) == [1, 0, 0, 1, 0, 0]
    assert col_values(df, codes.cap_to_sentinel("x", 15, 1000)) == [-1.0, 15.0, 1000.0, -1.0, -1.0, None]


def test_select_by_type(spark):
    df = spark.createDataFrame([("Apartment", 1, 2), ("House", 1, 2), (None, 1, 2), ("Other", 1, 2)],
                               "t string, a int, h int")
    assert col_values(df, codes.select_by_type("t", "Apartment", "a", "h")) == [1, 2, 2, 2]
    assert col_values(df, F.col("t")) == ["Apartment", "House", None, "Other"]


def test_clean_numeric_strict_raises(spark):
    import pytest
    ok = one_col(spark, ["12 m", None, "nan"])
    assert col_values(ok, text.clean_numeric_string("x", strict=True)) == [12.0, None, None]
    bad = one_col(spark, ["12 m", "wide"])
    with pytest.raises(Exception):
        bad.select(text.clean_numeric_string("x", strict=True)).collect()
