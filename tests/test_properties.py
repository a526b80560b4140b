"""Property tests: distributed order helpers equal their sequential definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logweave.operators.ordered import next_after, suppress_repeats

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
times = st.lists(st.integers(min_value=0, max_value=3000), min_size=1, max_size=60, unique=True)


def _fold(ts, quiet):
    fired, last = set(), None
    for t in sorted(ts):
        if last is None or t > last + quiet:
            fired.add(t)
            last = t
    return fired


@SETTINGS
@given(ts=times, quiet=st.integers(min_value=1, max_value=400), bucket=st.integers(min_value=1, max_value=500))
def test_doubling_fold_equals_sequential(spark, ts, quiet, bucket):
    df = spark.createDataFrame([(t,) for t in ts], "t long")
    got = {r["t"] for r in suppress_repeats(df, "t", quiet, bucket=bucket).where("fired").collect()}
    assert got == _fold(ts, quiet)


@SETTINGS
@given(ts=times, offset=st.integers(min_value=0, max_value=700), bucket=st.integers(min_value=1, max_value=500))
def test_next_after_equals_scan(spark, ts, offset, bucket):
    df = spark.createDataFrame([(t,) for t in ts], "t long")
    got = {r["t"]: r["next"] for r in next_after(df, "t", offset, bucket).collect()}
    assert got == {t: min((u for u in ts if u > t + offset), default=None) for t in ts}
