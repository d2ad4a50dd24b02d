import random
import time
from collections import Counter
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from samples import requests

from ramparts import rate_limit_breaches
from ramparts.operators.rate import client_rates, with_rate_flag
from ramparts.streaming import drained, rocksdb, stream_request_rates
from ramparts.streaming.rates import RateRing, window_counts


def brute(moments, window):
    """Count in (t - window, t] for each (client, t), one entry per request."""
    return Counter(
        (c, t, sum(1 for d, u in moments if d == c and t - window < u <= t)) for c, t in moments
    )


def test_window_edges(spark, rows):
    asked = requests(spark, *({"clientip": "a", "ts_ms": t} for t in [0, 299_999, 300_000, 900_000]))
    hits = rate_limit_breaches(asked, limit=1)
    assert rows(hits, "request_id", "window_count") == [("1", 2), ("2", 2)]


def test_uncounted_requests(spark, rows):
    asked = requests(
        spark,
        {"clientip": "a", "uri": "/HealthCheck/x"},
        {"clientip": "a", "uri": "/a"},
        {"clientip": "a", "uri": None},
        {"clientip": None, "uri": "/a"},
        {"clientip": None, "uri": "/a"},
    )
    assert rows(rate_limit_breaches(asked, limit=1), "request_id") == [("1",), ("2",)]
    flagged = with_rate_flag(asked, "f", limit=1)
    assert rows(flagged, "request_id", "f") == [("0", False), ("1", True), ("2", True), ("3", False), ("4", False)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 120)), min_size=1, max_size=60))
def test_against_brute_force(spark, moments):
    window = 10
    asked = requests(spark, *({"clientip": c, "ts_ms": t} for c, t in moments))
    hits = rate_limit_breaches(asked, limit=0, window_ms=window)
    assert Counter((r.clientip, r.ts_ms, r.window_count) for r in hits.collect()) == brute(moments, window)


@pytest.mark.parametrize("shift", [0, -1, 1])
def test_windows_across_slices(spark, shift):
    span = 7
    moments = [("a", span * n + d + shift) for n in (1, 2, 5) for d in (-10, -9, -1, 0, 0, 1, 9, 10)]
    asked = requests(spark, *({"clientip": c, "ts_ms": t} for c, t in moments))
    rates = {(r.clientip, r.ts_ms, r.window_count) for r in client_rates(asked, 10, slice_ms=span).collect()}
    assert rates == set(brute(moments, 10))


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_only_suspect_buckets_are_looked_at_and_none_is_missed(spark, limit):
    moments = [("a", t) for t in (0, 9, 10, 11, 19, 35, 36, 44, 45, 46, 90)] + [("b", t) for t in (5, 14, 15, 16)]
    asked = requests(spark, *({"clientip": c, "ts_ms": t} for c, t in moments))
    hits = rate_limit_breaches(asked, limit=limit, window_ms=10)
    expected = Counter({k: n for k, n in brute(moments, 10).items() if k[2] > limit})
    assert Counter((r.clientip, r.ts_ms, r.window_count) for r in hits.collect()) == expected


def test_one_client_with_everything_is_spread_out(spark):
    """One client sends all requests: its timeline is cut into many window groups, none big."""
    asked = spark.range(200_000).selectExpr(
        "cast(id AS string) AS request_id", "'10.0.0.1' AS clientip", "'/' AS uri", "id * 100 AS ts_ms"
    )
    rates = client_rates(asked, window_ms=300_000)
    assert rates.count() == 200_000
    # 3000 requests are in a full window; the first window fills up.
    assert rates.agg({"window_count": "max"}).first()[0] == 3000
    assert rates.filter("window_count = 3000").count() == 200_000 - 2999


def test_copies_are_summed_before_the_window(spark, plan):
    asked = spark.range(100_000).selectExpr(
        "cast(id AS string) AS request_id", "'10.0.0.1' AS clientip", "'/' AS uri", "cast(7 AS bigint) AS ts_ms"
    )
    hits = rate_limit_breaches(asked, limit=50)
    assert hits.count() == 100_000 and hits.filter("window_count = 100000").count() == 100_000
    text = plan(client_rates(asked))
    assert text.index("Window") < text.index("HashAggregate") and "partial_count" in text


def test_stream_gives_the_verdict_of_the_batch(spark, tmp_path, rows):
    """However the requests are cut into micro-batches, late ones included, the last count of a moment is that of the batch."""
    draw = random.Random(2)
    start = 1_704_423_600_000
    asked = [(f"c{draw.randrange(4)}", start + draw.randrange(0, 2000) * draw.choice([1, 7, 300]), "/") for _ in range(400)]
    asked += [("c1", start, "/healthcheck"), (None, start, "/"), ("c1", start, "/"), ("c1", start, "/")]
    schema = "clientip string, ts_ms bigint, uri string"
    for batches in (1, 5):
        folder = tmp_path / f"in{batches}"
        for n in range(batches):
            part = spark.createDataFrame(asked[n::batches], schema).coalesce(1)
            part.write.mode("append").parquet(str(folder / f"part={n}"))
            time.sleep(1.1)
        stream = spark.readStream.schema(f"{schema}, part int").option("maxFilesPerTrigger", 1).parquet(str(folder)).drop("part")
        with rocksdb(spark):
            found = drained(
                stream_request_rates(stream, 60_000, "1 day"), str(tmp_path / f"out{batches}"), str(tmp_path / f"state{batches}")
            )
        assert rows(found, "clientip", "ts_ms", "window_count") == rows(
            client_rates(spark.createDataFrame(asked, schema), 60_000), "clientip", "ts_ms", "window_count"
        )
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_window_counts_reach_back_one_window():
    moments = [(0, 2), (5, 1), (10, 1), (14, 3), (30, 1)]
    assert list(window_counts(moments, [0, 5, 10, 14, 30], 10)) == [(0, 2), (5, 3), (10, 2), (14, 5), (30, 1)]
    assert list(window_counts(moments, [5], 10)) == [(5, 3), (10, 2), (14, 5)]


def test_a_client_costs_few_state_calls():
    """A micro-batch reads and writes a client's state once, however many moments it brings; one timer stands for it."""
    calls, held = Counter(), {}

    class Handle:
        def getValueState(self, name, schema):
            return self

        def get(self):
            calls["get"] += 1
            return held.get("value")

        def update(self, value):
            calls["update"] += 1
            held["value"] = value

        def clear(self):
            held.clear()

        def registerTimer(self, moment):
            calls[moment] += 1

    def at(watermark):
        return SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)

    ring = RateRing(10)
    ring.init(Handle())
    first = list(ring.handleInputRows(("a",), [SimpleNamespace(ts_ms=t, n=1) for t in range(100)], at(0)))
    assert len(first) == 100 and calls == {"get": 1, "update": 1, 109: 1}
    late = list(ring.handleInputRows(("a",), [SimpleNamespace(ts_ms=95, n=2)], at(90)))
    assert [(r.ts_ms, r.window_count) for r in late] == [(t, 12) for t in range(95, 100)]
    assert calls == {"get": 2, "update": 2, 109: 1}
    assert list(ring.handleExpiredTimer(("a",), at(108), None)) == [] and held and calls[109] == 2
    assert list(ring.handleExpiredTimer(("a",), at(109), None)) == [] and not held
