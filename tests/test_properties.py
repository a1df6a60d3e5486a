"""Property tests: the arithmetic HHMM expression equals the text rule."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tabreg.functions import day_part, hhmm_to_minutes


def text_rule(t):
    """The rule as the original states it: truncate to int, read as text,
    last two characters are minutes, the rest hours (a bare sign fails)."""
    if t is None:
        return None
    i = 0 if math.isnan(t) else int(max(min(t, 2147483647.0), -2147483648.0))
    s = str(i)
    hour = 0
    if len(s) > 2:
        try:
            hour = int(s[:-2])
        except ValueError:
            return None
    return float(hour * 60 + int(s[-2:]))


def day_rule(t):
    if t is None:
        return None
    if 1.0 <= t <= 1125.0:
        return "Morning"
    if 1125.0 < t <= 1750.0:
        return "Afternoon"
    return "Evening"


values = st.one_of(
    st.none(),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
    st.integers(min_value=-3000, max_value=3000).map(float),
    st.sampled_from([float("nan"), 3e9, -3e9, 2400.0, 1125.0, 1750.0, -99.0, -10.0, -9.0]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(values, min_size=1, max_size=300))
def test_hhmm_equals_text_rule(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t double")
    got = dict(df.select("i", hhmm_to_minutes("t").alias("m"), ).collect())
    for i, x in enumerate(xs):
        assert got[i] == text_rule(x), (x, got[i], text_rule(x))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-10, max_value=3000, allow_nan=False)),
                min_size=1, max_size=300))
def test_day_part_equals_rule(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t double")
    got = dict(df.select("i", day_part("t").alias("d")).collect())
    for i, x in enumerate(xs):
        assert got[i] == day_rule(x), x
