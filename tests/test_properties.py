"""Property tests: Spark column functions against plain-Python definitions."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from groundstop.functions import hash_sample, hash_threshold, hour_of_departure, hour_text, route_key

times = st.lists(st.integers(min_value=0, max_value=2359).filter(lambda t: t % 100 < 60), min_size=1, max_size=40)
codes = st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ", min_size=3, max_size=3)


@settings(max_examples=15, deadline=None)
@given(times)
def test_hour_matches_integer_division(spark, ts):
    df = spark.createDataFrame([(str(t),) for t in ts], "t string")
    rows = df.select(hour_of_departure("t").alias("h"), hour_text("t").alias("x")).collect()
    assert [r.h for r in rows] == [t // 100 for t in ts]
    assert [r.x for r in rows] == [f"{t // 100:02d}" for t in ts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(codes, codes), min_size=1, max_size=30))
def test_route_key_symmetric(spark, pairs):
    df = spark.createDataFrame(pairs, "o string, d string")
    fwd = [r[0] for r in df.select(route_key("o", "d")).collect()]
    back = [r[0] for r in df.select(route_key("d", "o")).collect()]
    assert fwd == back == [f"{min(o, d)}<>{max(o, d)}" for o, d in pairs]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=12), min_size=1, max_size=50, unique=True),
       st.floats(min_value=0.0, max_value=1.0))
def test_hash_sample_matches_md5_prefix(spark, keys, fraction):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k for r in df.where(hash_sample("k", fraction)).collect()}
    bound = hash_threshold(fraction)
    want = {k for k in keys if hashlib.md5(k.encode()).hexdigest()[:8] < bound}
    assert got == want
