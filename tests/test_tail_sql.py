"""The oracle's t tail against closed forms and Spark's own p values, from 1 to a million degrees of freedom."""

import math

import duckdb
import pytest

from tabreg.operators import estimators, features, metrics
from tabreg.plans.tail_sql import t_tail_cte


def tail(cases):
    values = ", ".join(f"({i}, {t!r}::double, {d!r}::double)" if math.isfinite(t) else f"({i}, '{t}'::double, {d!r}::double)"
                       for i, (t, d) in enumerate(cases))
    got = duckdb.sql(f"with recursive src(k, t, dof) as (values {values}), {t_tail_cte('src')} select k, p from t_tail").fetchall()
    assert len(got) == len(cases)
    return [p for _, p in sorted(got)]


TS = [-30.0, -2.5, -1e-6, 1e-3, 0.4, 1.0, 1.96, 7.0, 200.0]


def test_one_and_two_degrees():
    for t, p in zip(TS, tail([(t, 1.0) for t in TS])):
        assert p == pytest.approx(1 - 2 / math.pi * math.atan(abs(t)), rel=1e-9)
    for t, p in zip(TS, tail([(t, 2.0) for t in TS])):
        assert p == pytest.approx(1 - abs(t) / math.sqrt(2 + t * t), rel=1e-8, abs=1e-12)


def test_many_degrees_near_the_normal():
    for t, p in zip(TS, tail([(t, 1e6) for t in TS])):
        assert p == pytest.approx(math.erfc(abs(t) / math.sqrt(2)), abs=1e-6)


def test_falls_with_t_and_ends():
    ps = tail([(t / 10, 9.0) for t in range(0, 80)])
    assert ps[0] == 1 and all(a > b for a, b in zip(ps, ps[1:]))
    assert tail([(float("inf"), 4.0), (float("-inf"), 4.0)]) == [0, 0]


@pytest.mark.parametrize("n", [5, 8, 40, 3000])
def test_equals_spark(spark, n):
    rows = [(float(i % 7), float(i * i % 11), 0.3 * (i % 7) + math.sin(i * 1.7)) for i in range(n)]
    data = features.vector_assembler(["a", "b"]).transform(spark.createDataFrame(rows, "a double, b double, y double"))
    model = estimators.linear_regression("y", features.FEATURES, regParam=0.0, solver="normal").fit(data)
    stats = metrics.coefficient_stats(model, ["a", "b"]).collect()
    got = tail([(r.t_value, float(n - 3)) for r in stats])
    assert got == pytest.approx([r.p_value for r in stats], abs=1e-9)
