"""Keyed checkpoints, running counters and streamed rates, against the batch forms."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from walletscope.operators.checkpoints import checkpoint_fold, final_checkpoints
from walletscope.operators.ingest import first_arrival
from walletscope.operators.rates import rate
from walletscope.operators.rules import rule_ingestion_stalled
from walletscope.sinks.commits import entries
from walletscope.streaming import counters, keyed, runs, stalls

SCHEMA = ("event_id string, chain string, address string, provider string, lt bigint, tx_hash string, "
          "block_time timestamp, arrival_seq bigint, arrived_at timestamp")
START = datetime(2024, 1, 1)


def arrivals(seed, n=400, wallets=5):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        lt, h, a = rng.randint(1, 6) + seq // 8, rng.choice("aaab"), f"W{rng.randrange(wallets)}"
        rows.append((f"{a}-{lt}-{h}", "ton", a, "p", lt, h, START + timedelta(minutes=lt), seq, START + timedelta(seconds=seq)))
    return rows


def land(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def texts(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_keyed_outcomes_equal_the_fold_over_waves_a_restart_and_a_new_log(spark, tmp_path, seed):
    rows = arrivals(seed)
    out = [f"{tmp_path}/out0", f"{tmp_path}/out1"]
    for number, (a, b) in enumerate([(0, 150), (150, 250), (250, 400)]):
        log = int(number == 2)
        stream = land(spark, rows[a:b] + rows[:20] * number, f"{tmp_path}/in{log}")  # with copies of what came before
        known = spark.read.schema(keyed.OUTCOME).parquet(out[0]) if log else None
        runs.append_available(keyed.outcomes(stream, known), out[log], f"{tmp_path}/log{log}")
    got = spark.read.schema(keyed.OUTCOME).parquet(*out)
    whole = first_arrival(spark.createDataFrame(rows, SCHEMA)).cache()
    fold = checkpoint_fold(whole).where("outcome <> 'ignore'")
    assert fold.where("outcome = 'conflict'").count() > 5
    assert texts(got.select(*fold.columns)) == texts(fold)
    assert texts(keyed.checkpoints(got)) == texts(final_checkpoints(whole))


def test_state_grows_with_wallets_and_not_with_batches(spark, tmp_path):
    sizes = []
    for number in range(4):
        rows = [(f"{number}-{i}", "ton", f"W{i % 3}", "p", 100 * number + i, "h", START, 100 * number + i, START) for i in range(60)]
        query = (keyed.outcomes(land(spark, rows, f"{tmp_path}/in")).writeStream.format("parquet").option("path", f"{tmp_path}/out")
                 .option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start())
        query.awaitTermination()
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert len(set(sizes)) == 1


def test_totals_equal_the_batch_count_after_every_wave(spark, tmp_path):
    rows, root = arrivals(3), f"{tmp_path}/out"
    rows += [(None, None, "W", "p", 1, "h", START, 999, START)] * 3  # no label
    step = counters.upsert(root, "seen", ["chain", "address"])
    for a, b in ((0, 100), (100, 101), (101, 403)):
        stream = land(spark, rows[a:b], f"{tmp_path}/in")
        counters.run_updates(counters.totals(stream, ["chain", "address"]), step, f"{tmp_path}/log")
        expected = spark.createDataFrame(rows[:b], SCHEMA).groupBy("chain", "address").agg(F.count("*").alias("total"))
        assert texts(counters.read_totals(spark, root, "seen", ["chain", "address"])) == texts(expected)
    counters.run_updates(counters.totals(land(spark, rows[:7], f"{tmp_path}/in2"), ["chain", "address"]), step, f"{tmp_path}/log2")
    assert counters.read_totals(spark, root, "seen", ["chain", "address"]).agg(F.sum("total")).first()[0] == len(rows) + 7


def test_a_replayed_batch_of_totals_changes_nothing(spark, tmp_path):
    step = counters.upsert(str(tmp_path), "seen", ["chain"], run="r")
    first, second = (spark.createDataFrame(rows, "chain string, total bigint") for rows in ([("a", 3), ("b", 1)], [("a", 5)]))
    for number, rows in ((0, first), (1, second), (1, second), (1, second)):
        step(rows, number)
    assert sorted(map(tuple, counters.read_totals(spark, str(tmp_path), "seen", ["chain"]).collect())) == [("a", 5), ("b", 1)]
    assert len(entries(spark, str(tmp_path))) == 2


def test_streamed_rate_equals_the_batch_rate_of_closed_windows(spark, tmp_path):
    """Waves in and out of order: late rows are counted once, in an output of their own."""
    rng, root = random.Random(4), f"{tmp_path}/out"
    rows = [(f"e{i}", "ton", "A", "p", i, "h", START + timedelta(seconds=rng.randrange(7200)), i, START) for i in range(500)]
    rows[100] = (*rows[100][:6], START + timedelta(hours=2, seconds=30, microseconds=999), *rows[100][7:])
    for a, b in ((0, 60), (60, 250), (250, 500)):
        stream = land(spark, rows[a:b], f"{tmp_path}/in")
        runs.run_available(counters.minutes(stream, "block_time", "chain", "5 minutes"), counters.keep_minutes(root, "5 minutes"), f"{tmp_path}/log")
        end = spark.range(1).select(counters.closed_until(spark, root)).first()[0]
        assert end == max(r[6] for r in rows[:b]).replace(second=0, microsecond=0) - timedelta(minutes=5)
        seen = spark.createDataFrame(rows[:b], SCHEMA).where(F.date_trunc("minute", "block_time") < F.lit(end))
        expected = rate(seen, F.col("block_time"), "chain").where(F.col("window_end") <= F.lit(end))
        assert texts(counters.read_rate(spark, root)) == texts(expected.select("series", "window_end", "increase", "rate"))
    late = spark.read.parquet(f"{root}/late_minutes").agg(F.sum("n")).first()[0]
    assert 200 < late < 440


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stalls_by_timers_equal_the_batch_rule(spark, tmp_path, seed):
    """Chains that fall silent in the middle and at the end; rows out of order within the delay; changing clock rows."""
    rng, rows, at = random.Random(seed), [], START
    for _ in range(260):
        at += timedelta(seconds=rng.choice([1, 30, 200, 660, 661, 900, 4000]), microseconds=rng.choice([0, 0, 1]))
        rows.append((rng.choice(["a", "b", "b", "c" if at < START + timedelta(hours=20) else "a"]), at - timedelta(seconds=rng.choice([0, 0, 250]))))
    as_of = rows[-1][1] + timedelta(minutes=rng.choice([5, 300]))
    schema = "chain string, block_time timestamp"
    for a, b in ((0, 50), (50, 51), (51, 180), (180, 260), (260, 260)):
        part = rows[a:b] + [(None, as_of + timedelta(minutes=10))] * (a == 260)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        runs.append_available(stalls.stalls(stream, "chain", "block_time"), f"{tmp_path}/out", f"{tmp_path}/log")
    changes = spark.read.schema(stalls.CHANGE).parquet(f"{tmp_path}/out")
    expected = rule_ingestion_stalled(spark.createDataFrame(rows, schema), F.lit(as_of).cast("timestamp"))
    got = stalls.firing(changes, F.lit(as_of).cast("timestamp"))
    assert expected.count() > 20 and texts(got) == texts(expected.select(*got.columns))
    opened = changes.where("ends_us IS NULL AND key = 'c'").agg(F.max("starts_us")).first()[0]
    assert opened is not None  # the chain that went quiet for good


def test_a_key_of_many_rows_sends_two_times_per_bucket_to_its_task():
    class Timers:
        def getCurrentWatermarkInMs(self):  # noqa: N802
            return 1_500_000

    rng = random.Random(4)
    times = [rng.randrange(2_000_000_000) for _ in range(5000)] + [1_000_000_000, 1_999_999_999]
    rows = [Row(at_us=t) for t in times] + [Row(at_us=None)]
    got = list(stalls.Ends(660).handleInputRows(("a", 0), iter(rows), Timers()))
    assert len(got) == 4 and all(r.at.timestamp() > 1500 for r in got)
    for r in got:
        mine = [t for t in times if t // 660_000_000 == r.first_us // 660_000_000]
        assert (r.first_us, r.last_us) == (min(mine), max(mine))


def test_rows_of_a_key_are_spread_over_slices_before_they_meet(spark, tmp_path, capsys):
    schema = "chain string, block_time timestamp"
    rows = [("a", START + timedelta(seconds=17 * i)) for i in range(3000)] + [("a", None), (None, START + timedelta(days=1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    found = stalls.stalls(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "chain", "block_time")
    found.explain()
    assert "slice" in capsys.readouterr().out
    runs.append_available(found, f"{tmp_path}/out", f"{tmp_path}/log")
    opened = spark.read.schema(stalls.CHANGE).parquet(f"{tmp_path}/out").collect()
    assert [(r.key, r.ends_us) for r in opened] == [("a", None)]


def test_a_wallet_asks_the_state_a_few_times_per_batch():
    calls, held = [], {"mark": None, "rivals": {}}

    class Mark:
        def exists(self):
            calls.append("exists")
            return held["mark"] is not None

        def get(self):
            calls.append("get")
            return held["mark"]

        def update(self, value):
            calls.append("update")
            held["mark"] = value

    class Rivals:
        def clear(self):
            calls.append("clear")
            held["rivals"].clear()

        def containsKey(self, key):  # noqa: N802
            calls.append("contains")
            return key in held["rivals"]

        def updateValue(self, key, value):  # noqa: N802
            calls.append("put")
            held["rivals"][key] = value

    marks = keyed.Marks()
    marks.mark, marks.rivals = Mark(), Rivals()

    def batch(*rows):
        calls.clear()
        given = [Row(event_id=f"{lt}{h}", lt=lt, tx_hash=h, arrival_seq=i, arrived_at=START) for i, (lt, h) in enumerate(rows)]
        return [(r.event_id, r.outcome) for r in marks.handleInputRows(("ton", "a", "p"), iter(given), None)]

    assert batch(*((lt, "a") for lt in range(500)), (499, "b"), (499, "b")) == [
        *((f"{lt}a", "advance") for lt in range(500)), ("499b", "conflict")]
    assert len(calls) <= 3 and held == {"mark": (499, "a"), "rivals": {("499b",): (True,)}}
    assert batch((499, "b"), (499, "c"), (7, "a")) == [("499c", "conflict")]
    assert batch((499, "c"), (600, "a"), (600, "b"), (700, "a")) == [("600a", "advance"), ("600b", "conflict"), ("700a", "advance")]
    assert held == {"mark": (700, "a"), "rivals": {}}
