import pytest

from odd_rows import EN, SCHEMA


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{k % 997} tail{k}" for k in range(30_000))
    texts = [None, "", " \n\t", "one", EN, EN, EN.upper(), EN + " indeed", long, "x" * 50_000, "123 456", "\n".join([EN] * 4)]
    rows = [(k, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None, 1, 2, "clash", 3)
            for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, EN, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
