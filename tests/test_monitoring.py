import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from walletscope.operators import gauges, lag, rates, retries, rules
from walletscope.plans.hot import HotRule

ALL_HOT = HotRule(rows=0)
START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def as_of(seconds):
    return F.to_timestamp(F.lit(at(seconds).strftime("%Y-%m-%d %H:%M:%S")))


def checkpoints(spark, *rows):
    return spark.createDataFrame([("ton", a, p, 1, "h", at(t)) for a, p, t in rows],
                                 "chain string, address string, provider string, last_lt bigint, "
                                 "last_hash string, updated_at timestamp")


def test_lag_takes_the_newest_provider_and_is_strict(spark):
    marks = checkpoints(spark, ("A", "p1", 0), ("A", "p2", 100), ("B", "p1", 99))
    got = {r.address: r.lag_seconds for r in lag.event_lag(marks, as_of(1000)).collect()}
    assert got == {"A": 900.0, "B": 901.0}
    assert [r.address for r in lag.stale_checkpoints(marks, as_of(1000)).collect()] == ["B"]
    assert [r.address for r in lag.stale_checkpoints(marks, as_of(1000), 0).collect()] == ["B"]
    assert lag.stale_wallets_by_chain(marks, as_of(500)).first().stale_wallets == 0
    assert lag.max_lag(marks, as_of(1000)).first()[0] == 901.0


def test_dead_letters(spark):
    rows = [("q", "one", False)] + [("q", "two", False)] * 2 + [("q", "three", False)] * 3 + [("q", "null", True)]
    df = spark.createDataFrame(rows, "queue string, message_id string, undecodable boolean")
    got = {r.message_id: (r.disposition, r.reason, r.delay_seconds) for r in retries.dead_letters(df).collect()}
    assert got == {"one": ("retry", None, 1), "two": ("retry", None, 5),
                   "three": ("dead", "max_retries", None), "null": ("dead", "undecodable", None)}
    more = {r.message_id: r.delay_seconds for r in retries.dead_letters(df, max_retries=9, delays=(1, 5)).collect()}
    assert more["three"] == 5
    assert retries.dlq_depth(retries.dead_letters(df)).first().dead_messages == 2


def samples(spark, rows):
    return spark.createDataFrame([(s, at(t), float(v), i) for i, (s, t, v) in enumerate(rows)],
                                 "series string, ts timestamp, value double, sample_id bigint")


def brute_hold(rows, test, hold):
    series = defaultdict(list)
    for i, (s, t, v) in enumerate(rows):
        series[s].append((t, i, test(v)))
    result = set()
    for s, points in series.items():
        run = []
        for t, _, ok in sorted(points) + [(None, None, False)]:
            if ok:
                run.append(t)
            elif run:
                if run[-1] - run[0] >= hold:
                    result.add((s, run[0], run[-1], len(run)))
                run = []
    return result


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("hold", [0, 300])
def test_hold_for_against_brute_force(spark, hot, hold):
    rng = random.Random(hold)
    rows = [(rng.choice(["h", "h", "h", "c"]), rng.randrange(0, 20000, 10), rng.randint(0, 3))
            for _ in range(600)]
    got = rules.hold_for(samples(spark, rows), F.col("value") > 0, hold, rule=ALL_HOT if hot else HotRule())
    assert {(r.series, int((r.active_at - START).total_seconds()), int((r.ends_at - START).total_seconds()),
             r.samples) for r in got.collect()} == brute_hold(rows, lambda v: v > 0, hold)


def test_hold_edge_is_inclusive(spark):
    df = samples(spark, [("s", 0, 1), ("s", 60, 1), ("t", 0, 1), ("t", 59, 1)])
    assert [r.series for r in rules.hold_for(df, F.col("value") > 0, 60).collect()] == ["s"]


def test_several_rules_on_one_metric_in_one_pass(spark):
    df = samples(spark, [("s", t, v) for t, v in ((0, 1), (60, 5), (120, 5), (180, 0), (240, 9))]).withColumn(
        "metric", F.lit("m"))
    low = rules.SampledRule("low", "warning", "m", lambda: F.col("value") > 0, 60)
    high = rules.SampledRule("high", "critical", "m", lambda: F.col("value") > 4, 0)
    other = rules.SampledRule("other", "critical", "n", lambda: F.lit(True), 0)
    got = sorted((r.alert, r.severity, r.starts_at, r.ends_at)
                 for r in rules.sampled_rules(df, [low, high, other]).collect())
    assert got == [("high", "critical", at(60), at(120)), ("high", "critical", at(240), at(240)),
                   ("low", "warning", at(60), at(120))]


def quiet_rows(spark, rows):
    return spark.createDataFrame([("ton", a, at(t), at(t)) for a, t in rows],
                                 "chain string, address string, block_time timestamp, arrived_at timestamp")


def test_stall_edges(spark):
    df = quiet_rows(spark, [("A", 0), ("A", 660), ("A", 660 + 661), ("A", 1400)])
    got = [(r.starts_at, r.ends_at) for r in rules.rule_ingestion_stalled(df, as_of(1400 + 700))
           .orderBy("starts_at").collect()]
    assert got == [(at(660 + 660), at(1321)), (at(1400 + 660), at(2100))]
    assert rules.rule_ingestion_stalled(df, as_of(1500)).count() == 1


def test_quiet_intervals_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice("AAAB"), rng.randint(0, 400000)) for _ in range(400)]
    got = {(r.series, r.starts_at, r.ends_at) for r in
           rules.rule_lag_high(quiet_rows(spark, rows), as_of(500000)).collect()}
    expected = set()
    for address in "AB":
        times = sorted(t for a, t in rows if a == address) + [500000]
        for t, following in zip(times, times[1:]):
            if following - t > 1860:
                expected.add((f"address={address},chain=ton", at(t + 1860), at(following)))
    assert got == expected


def firing(spark, rows):
    return spark.createDataFrame([(n, s, "x", at(b), at(e)) for n, s, b, e in rows],
                                 "alert string, severity string, series string, starts_at timestamp, "
                                 "ends_at timestamp")


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("span", [30000, 3000])  # over hours, and all in one hour
def test_merge_intervals_against_brute_force(spark, hot, span):
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        begin = rng.randrange(0, span, 5)
        rows.append((rng.choice(["a", "a", "b"]), "warning", begin, begin + rng.choice([0, 5, 10, 60, 600])))
    got = {(r.alert, r.starts_at, r.ends_at) for r in rules.merge_intervals(
        firing(spark, rows), ["alert", "severity"], rule=ALL_HOT if hot else HotRule()).collect()}
    expected = set()
    for name in "ab":
        current = None
        for begin, end in sorted((b, e) for n, _, b, e in rows if n == name):
            if current and begin <= current[1]:
                current = (current[0], max(current[1], end))
            else:
                if current:
                    expected.add((name, at(current[0]), at(current[1])))
                current = (begin, end)
        expected.add((name, at(current[0]), at(current[1])))
    assert got == expected


def test_notification_schedule(spark):
    rows = [("c", "critical", 0, 7210), ("w", "warning", 0, 9), ("w2", "warning", 0, 10),
            ("i", "info", 0, 43300), ("c", "critical", 3600, 7000)]
    got = sorted((r.alert, r.receiver, int((r.sent_at - START).total_seconds()))
                 for r in rules.notification_schedule(firing(spark, rows)).collect())
    assert got == [("c", "critical", 10), ("c", "critical", 3610), ("c", "critical", 7210),
                   ("i", "default", 10), ("i", "default", 43210), ("w2", "warning", 10)]


def test_rate_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), rng.randint(0, 3600)) for _ in range(200)]
    df = spark.createDataFrame([(k, at(t)) for k, t in rows], "kind string, ts timestamp")
    got = {(r.series, int((r.window_end - START).total_seconds())): (r.increase, r.rate)
           for r in rates.rate(df, F.col("ts"), "kind").collect()}
    expected = defaultdict(int)
    for end in range(60, 3600 + 600, 60):
        for k, t in rows:
            if end - 300 <= t < end:
                expected[(k, end)] += 1
                expected[("*", end)] += 1
    for series in "xy*":  # windows of the time between without rows count 0
        ends = [e for s, e in expected if s == series]
        for end in range(min(ends), max(ends), 60):
            expected[(series, end)] += 0
    assert got == {k: (n, n / 300.0) for k, n in expected.items()}


def test_counter_reset_counts_from_zero(spark):
    df = samples(spark, [("s", 0, 5), ("s", 60, 8), ("s", 120, 2), ("s", 86400, 4), ("t", 0, 1)])
    got = [r.increase for r in rates.counter_increases(df.where("series = 's'")).orderBy("ts").collect()]
    assert got == [0.0, 3.0, 2.0, 2.0]


def test_health_bands(spark):
    values = [("dlq_messages", 0.0, "green"), ("dlq_messages", 1.0, "red"), ("circuit_breaker_state", 1.0, "yellow"),
              ("circuit_breaker_state", 2.0, "red"), ("event_lag_seconds", 1799.0, "green"),
              ("event_lag_seconds", 1800.0, "yellow"), ("event_lag_seconds", 3600.0, "red"),
              ("discovery_age_seconds", 7200.0, "red"), ("event_lag_stale_wallets", 4.0, "yellow"),
              ("event_lag_stale_wallets", 5.0, "red"), ("other", 5.0, None)]
    df = spark.createDataFrame([v[:2] for v in values], "metric string, value double").coalesce(1)
    got = [(r.metric, r.value, r.band) for r in gauges.health_bands(df).collect()]
    assert got == [v for v in values if v[2]]


def test_missing_discovery_counts_from_epoch(spark):
    empty = spark.createDataFrame([], "metric string, ts timestamp, value double, sample_id bigint")
    row = gauges.discovery_age(empty, as_of(0)).first()
    assert row.last_success == 0.0 and row.age_seconds == 1704067200.0


def test_series_key_is_sorted(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1"},), ({},)], "labels map<string,string>")
    assert [r[0] for r in df.select(gauges.series_key(F.col("labels"))).collect()] == ["a=1,b=2", ""]


def test_empty_windows_have_a_row(spark):
    df = spark.createDataFrame([("x", at(0)), ("x", at(3600))], "kind string, ts timestamp")
    got = {int((r.window_end - START).total_seconds()): r.increase
           for r in rates.rate(df, F.col("ts"), "kind").where("series = 'x'").collect()}
    assert got == {end: int(end <= 300 or end > 3600) for end in range(60, 3900 + 60, 60)}


def test_last_values_stand_in_the_max_series(spark):
    from walletscope.operators.gauges import gauge_max_series

    df = samples(spark, [("a", 30, 100), ("b", 90, 1), ("a", 150, 3), ("b", 155, 2)]).withColumn("metric", F.lit("lag"))
    got = {int((r.minute - START).total_seconds()) // 60: r.value for r in gauge_max_series(df, "lag").collect()}
    assert got == {0: 100.0, 1: 100.0, 2: 3.0, 3: 3.0, 4: 3.0, 5: 3.0, 6: 3.0}


def test_breaker_and_discovery_gauges(spark):
    from walletscope.operators.metrics import breaker_state, discovery_last_success

    changes = samples(spark, [("", 0, 2), ("", 60, 1)])
    assert breaker_state(changes).first().state == 1.0 and breaker_state(changes.limit(0)).first().state == 0.0
    held = spark.createDataFrame([(START,)], "updated_at timestamp")
    assert discovery_last_success(held).first().last_success == int(START.replace(tzinfo=timezone.utc).timestamp())
    assert discovery_last_success(held.limit(0)).count() == 0
