from math import ceil

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridloom.operators.filters import within_quartiles
from gridloom.operators.quantiles import approx_quartiles

SHARES = (0.25, 0.75)


def expected(values):
    ordered = sorted(values)
    return tuple(ordered[max(1, ceil(s * len(ordered))) - 1] for s in SHARES)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(-5, 5).map(float) | st.floats(-1e6, 1e6), min_size=1, max_size=60)
)
def test_quartiles_are_exact_below_the_accuracy(spark, values):
    assert tuple(approx_quartiles(frame(spark, values), "x").first()) == expected(values)


def test_one_value_holds_a_third_of_the_rows(spark):
    values = [50.0] * 1000 + [float(i) for i in range(2000)]
    assert tuple(approx_quartiles(frame(spark, values), "x").first()) == expected(values)


def test_a_coarse_sketch_stays_within_its_accuracy(spark):
    values = [float(i) for i in range(10_000)]
    q1, q3 = approx_quartiles(frame(spark, values), "x", accuracy=1_000).first()
    assert abs(q1 - 2_499) <= 10 and abs(q3 - 7_499) <= 10


def test_null_and_nan_are_ignored(spark):
    values = [None, float("nan"), 1.0, 2.0, 3.0, 4.0]
    assert tuple(approx_quartiles(frame(spark, values), "x").first()) == (1.0, 3.0)
    assert tuple(approx_quartiles(frame(spark, [None]), "x").first()) == (None, None)


def test_quartile_band_uses_the_floor(spark):
    values = [1.2, 2.9, 3.5, 4.1, 5.7, 6.6, 7.3, 8.8]
    band = within_quartiles(frame(spark, values), "x")
    q1, q3 = expected(values)
    kept = sorted(v for v in values if q1 <= v // 1 <= q3)
    rows = sorted(tuple(r) for r in band.collect())
    assert rows == [(v, int(v // 1), int(v // 1)) for v in kept]
    assert within_quartiles(frame(spark, [None]), "x").isEmpty()
