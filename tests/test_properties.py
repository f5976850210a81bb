"""Property test: text -> int matches truncation toward zero on every decimal text."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from arrivals.functions import text_to_int

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def expected(text):
    try:
        v = float(text)
    except (TypeError, ValueError):
        return None
    if math.isnan(v) or math.isinf(v):
        return None
    t = math.trunc(v)
    return t if INT_MIN <= t <= INT_MAX else None


texts = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False, width=64).map(repr),
    st.integers(min_value=-(2**40), max_value=2**40).map(str),
    st.integers(min_value=-(10**6), max_value=10**6).map(lambda i: f"{i}.0"),
    st.sampled_from(["", "x", "1.2.3", "--1", "NaN", "Infinity", "-0.0", "0.9999"]),
)


@settings(max_examples=40, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_text_to_int_matches_truncation(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.n for r in df.select("i", text_to_int("s").alias("n")).collect()}
    assert [got[i] for i in range(len(values))] == [expected(v) for v in values]
