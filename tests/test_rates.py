"""Rates of sampled counters, sample by sample, and across chunks of time."""
import math
import random

from quillstream.operators.rates import increases, sampled_rate


def rate_at(samples, t, range_ms=60_000):
    """(increase, per second) from (time, value) of one series, as the rule says it."""
    own = [(s, v) for s, v in samples if t - range_ms < s <= t]
    if len(own) < 2:
        return None
    grown = sum(b - a if b >= a else b for (_, a), (_, b) in zip(own, own[1:]))
    sampled = (own[-1][0] - own[0][0]) / 1000.0
    mean = sampled / (len(own) - 1)
    start, end = (own[0][0] - (t - range_ms)) / 1000.0, (t - own[-1][0]) / 1000.0
    start, end = (x if x < 1.1 * mean else mean / 2 for x in (start, end))
    if grown > 0:
        start = min(start, sampled * own[0][1] / grown)
    return grown, grown * (sampled + start + end) / sampled / (range_ms / 1000.0)


def test_random_series(spark):
    rng = random.Random(2)
    series = {}
    for name in "abc":
        value, rows = 0, []
        for t in sorted(rng.sample(range(0, 900_000, 2500), 90)):
            value = rng.randrange(5) if rng.random() < 0.1 else value + rng.randrange(9)
            rows.append((t, value))
        series[name] = rows
    series["one"] = [(1000, 5)]
    df = spark.createDataFrame([(n, t, v) for n, rows in series.items() for t, v in rows], "s string, sample_ms long, value long")
    got = {(r.s, r.scrape_ms): (r.increase, r.rate_per_sec) for r in sampled_rate(df, "s", chunk_ms=20_000).collect()}
    want = {(n, t): rate_at(rows, t) for n, rows in series.items() for t in range(0, 975_000, 15_000) if rate_at(rows, t)}
    assert set(got) == set(want) and len(want) > 100
    assert all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1], rel_tol=1e-12) for k in want)


def test_counter_resets(spark):
    df = spark.createDataFrame([("a", t, v) for t, v in enumerate([5, 9, 9, 2, 4])], "s string, t long, v long")
    for chunk in (1, 2, 100):
        assert [r.increase for r in increases(df, ["s"], "t", "v", chunk).orderBy("t").collect()] == [0, 4, 0, 2, 2]


def test_steady_counter_has_its_rate(spark):
    """One every second, sampled every 15 s from zero: the rate is 1 once the range is full."""
    df = spark.createDataFrame([("a", t * 1000, t) for t in range(0, 301, 15)], "s string, sample_ms long, value long")
    got = {r.scrape_ms: r.rate_per_sec for r in sampled_rate(df, "s").collect()}
    assert all(math.isclose(got[t], 1.0) for t in range(75_000, 300_001, 15_000)) and got[15_000] < 1
