import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from walletscope.operators import checkpoints, ingest, monitored
from walletscope.plans.hot import HotRule
from walletscope.plans.running import running_max, running_sum
from walletscope.plans.spread_join import spread_join

ALL_HOT = HotRule(rows=0)
ARRIVAL = ("chain string, address string, provider string, lt bigint, tx_hash string, arrival_seq bigint, "
           "event_id string, arrived_at timestamp")
START = datetime(2024, 1, 1)


def arrivals(spark, rows, address="A"):
    return spark.createDataFrame(
        [("ton", address, "tonapi", lt, h, i, f"{address}{i}", START + timedelta(seconds=i))
         for i, (lt, h) in enumerate(rows)], ARRIVAL)


def outcomes(df):
    return [r.outcome for r in df.orderBy("arrival_seq").collect()]


def brute_fold(rows, state=None):
    result = []
    for lt, h in rows:
        if state is None or lt > state[0]:
            result.append("advance")
            state = (lt, h)
        elif lt == state[0] and h != state[1]:
            result.append("conflict")
        else:
            result.append("ignore")
    return result, state


WORKED = [(100, "a"), (200, "b"), (200, "c"), (150, "z"), (100, "q"), (300, "d")]


@pytest.mark.parametrize("rule", [HotRule(), ALL_HOT])
def test_worked_example(spark, rule):
    got = outcomes(checkpoints.checkpoint_fold(arrivals(spark, WORKED), slice_rows=2, rule=rule))
    assert got == ["advance", "advance", "conflict", "ignore", "ignore", "advance"]


@pytest.mark.parametrize("rule", [HotRule(), ALL_HOT])
def test_fold_against_brute_force_with_a_hot_wallet(spark, rule):
    rng = random.Random(7)
    hot = [(rng.randint(1, 60), rng.choice("ab")) for _ in range(300)]
    cold = {f"W{i}": [(rng.randint(1, 9), rng.choice("ab")) for _ in range(rng.randint(1, 6))]
            for i in range(20)}
    df = arrivals(spark, hot, "HOT")
    for name, rows in cold.items():
        df = df.unionByName(arrivals(spark, rows, name))
    old = spark.createDataFrame([("ton", "HOT", "tonapi", 30, "a", START)],
                                "chain string, address string, provider string, last_lt bigint, "
                                "last_hash string, updated_at timestamp")
    fold = checkpoints.checkpoint_fold(df, old, slice_rows=16, rule=rule).collect()
    final = {r.address: (r.last_lt, r.last_hash) for r in checkpoints.final_checkpoints(df, old).collect()}
    for name, rows in {**cold, "HOT": hot}.items():
        expected, state = brute_fold(rows, (30, "a") if name == "HOT" else None)
        got = [r.outcome for r in sorted((r for r in fold if r.address == name), key=lambda r: r.arrival_seq)]
        assert got == expected and final[name] == state


def test_final_state_does_not_depend_on_arrival_order(spark):
    rows = [(100, "a"), (200, "b"), (150, "c"), (300, "d")]
    states = set()
    for order in itertools.permutations(rows):
        row = checkpoints.final_checkpoints(arrivals(spark, order)).first()
        states.add((row.last_lt, row.last_hash))
    assert states == {(300, "d")}


def test_updated_at_moves_only_on_advance(spark):
    row = checkpoints.final_checkpoints(arrivals(spark, [(200, "b"), (100, "a"), (200, "b")])).first()
    assert row.updated_at == START


def test_lookup_gives_no_row_for_unknown(spark):
    state = checkpoints.final_checkpoints(arrivals(spark, WORKED))
    assert checkpoints.checkpoint_lookup(state, "ton", "A", "tonapi").count() == 1
    assert checkpoints.checkpoint_lookup(state, "ton", "B", "tonapi").count() == 0


@pytest.mark.parametrize("rule", [HotRule(), ALL_HOT])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_aggregates_equal_plain_windows(spark, rule, inclusive):
    from pyspark.sql import Window

    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice(["h"] * 8 + ["c", "d"]), i, rng.randint(0, 99))
                                for i in range(400)], "k string, o bigint, v bigint")
    w = (Window.partitionBy("k").orderBy("o")
         .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    cut = F.expr("o div 32")
    mx = running_max(df, ["k"], ["o"], cut, F.col("v"), "m", inclusive, rule)
    sm = running_sum(df, ["k"], ["o"], cut, F.col("v"), "s", inclusive, rule)
    plain = df.select("*", F.max("v").over(w).alias("m"), F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"))
    assert sorted(map(repr, mx.collect())) == sorted(map(repr, plain.drop("s").collect()))
    assert sorted(map(repr, sm.collect())) == sorted(map(repr, plain.drop("m").collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rule", [HotRule(), ALL_HOT, HotRule(rows=40)])
def test_spread_join_equals_plain_join(spark, how, rule):
    rows = [("h" if i % 3 else f"k{i % 20}", i) for i in range(500)] + [(None, i) for i in range(40)]
    big = spark.createDataFrame(rows, "k string, lt bigint")
    state = spark.createDataFrame([("h", 1), ("k3", 2), ("k6", 3), ("gone", 4)], "k string, s bigint")
    got = spread_join(big, state, ["k"], how, "lt", rule)
    plain = big.join(state, "k", how)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_null_keys_are_cut_like_others(spark):
    df = spark.createDataFrame([(None, i, i % 7) for i in range(200)] + [("k", i, i % 5) for i in range(9)],
                               "k string, o bigint, v bigint")
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    got = running_max(df, ["k"], ["o"], F.expr("o div 16"), F.col("v"), "m", rule=HotRule(rows=20))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.withColumn("m", F.max("v").over(w)).collect()))


def test_hot_rule_finds_only_large_shares(spark):
    from walletscope.plans.hot import hot_keys

    df = spark.createDataFrame([("h",)] * 60 + [(f"k{i}",) for i in range(40)] + [(None,)], "k string")
    assert [r.k for r in hot_keys(df, ["k"], HotRule(rows=10)).collect()] == ["h"]
    assert [r.k for r in hot_keys(df, ["k"], HotRule(rows=0, keys=1)).collect()] == ["h"]
    assert hot_keys(df, ["k"], HotRule(rows=100)).count() == 0


def test_first_arrival_keeps_the_first_payload(spark):
    df = spark.createDataFrame([("e", 2, "late"), ("e", 1, "first"), ("f", 5, "only")],
                               "event_id string, arrival_seq bigint, raw_json string")
    assert sorted((r.event_id, r.raw_json) for r in ingest.first_arrival(df).collect()) == [
        ("e", "first"), ("f", "only")]
    stored = spark.createDataFrame([("f",)], "event_id string")
    assert [r.event_id for r in ingest.new_events(df, stored).collect()] == ["e"]


@pytest.mark.parametrize("rule", [HotRule(), ALL_HOT])
def test_fetch_after_checkpoint(spark, rule):
    txs = spark.createDataFrame(
        [("ton", a, "tonapi", lt, f"h{lt}") for a in "AB" for lt in range(1, 251)],
        "chain string, address string, provider string, lt bigint, tx_hash string")
    marks = spark.createDataFrame([("ton", "A", "tonapi", 100, "h100")],
                                  "chain string, address string, provider string, last_lt bigint, last_hash string")
    got = ingest.fetch_after_checkpoint(txs, marks, rule=rule).collect()
    assert sorted(r.lt for r in got if r.address == "A") == list(range(101, 201))
    assert sorted(r.lt for r in got if r.address == "B") == list(range(1, 101))


MONITORED = ("chain string, address string, provider string, asset_id string, balance string, "
             "is_active boolean, discovered_at timestamp, updated_at timestamp")


def holdings(spark, *rows):
    return spark.createDataFrame([("ton", a, "tonapi", asset, b, active, START, START)
                                  for a, asset, b, active in rows], MONITORED)


def batch(spark, *rows):
    return spark.createDataFrame([("ton", a, "tonapi", asset, b, i) for i, (a, asset, b) in enumerate(rows)],
                                 "chain string, address string, provider string, asset_id string, "
                                 "balance string, arrival_seq bigint")


def now():
    return F.to_timestamp(F.lit("2024-02-01 00:00:00"))


def test_upsert_reactivates_and_keeps_discovery(spark):
    state = holdings(spark, ("addr1", "TON", "1000", False), ("addr2", "TON", "5", True))
    rows = {r.address: r for r in monitored.upsert_monitored(
        state, batch(spark, ("addr1", "TON", "2000"), ("addr1", "TON", "3000"), ("addr3", "TON", "1")),
        now()).collect()}
    assert (rows["addr1"].balance, rows["addr1"].is_active) == ("3000", True)
    assert rows["addr1"].discovered_at == START and rows["addr1"].updated_at == datetime(2024, 2, 1)
    assert (rows["addr2"].balance, rows["addr2"].updated_at) == ("5", START)
    assert rows["addr3"].is_active and rows["addr3"].discovered_at == datetime(2024, 2, 1)


def test_deactivate_and_count(spark):
    state = holdings(spark, ("addr1", "TON", "1000", True), ("addr1", "NOT", "5000", True),
                     ("addr2", "TON", "3000", True))
    assert monitored.active_wallet_count(state).first()[0] == 2
    one = holdings(spark, ("addr1", "TON", "1000", True), ("addr2", "TON", "3000", True))
    gone = monitored.deactivate_addresses(one, batch(spark, ("addr1", "TON", "0"), ("nobody", "TON", "0")), now())
    assert monitored.active_wallet_count(gone).first()[0] == 1 and gone.count() == 2
    assert [r.address for r in monitored.active_addresses(gone).collect()] == ["addr2"]


def test_value_order_of_wide_and_negative_balances(spark):
    values = ["5", "-3", "40", "9" * 40, "8" * 40 + "1", "-20", "0", "9" * 39, "-" + "9" * 40]
    df = spark.createDataFrame([(v, f"a{i}") for i, v in enumerate(values)], "balance string, address string")
    got = [r.balance for r in df.orderBy(*monitored.by_value()).collect()]
    assert got == sorted(values, key=int, reverse=True)


def test_failed_asset_is_skipped_and_all_failed_raises(spark):
    from walletscope.sources import holders

    good = spark.createDataFrame([('[{"account":"0:A","balance":"5"},{"account":"0:B","balance":"x"}]',)],
                                 "body string")
    bad = spark.createDataFrame([("0:m", "oops"), ("0:m", '{"jetton_wallets":[{"owner":"C","balance":"9"}]}')],
                                "master_address string, body string")
    tokens = spark.createDataFrame([("0:m", "TKN")], "master_address string, symbol string")
    docs = [holders.parse_native(good), holders.parse_jetton(bad, tokens)]
    rows = monitored.all_asset_holders(docs)
    assert sorted((r.asset_id, r.address, r.balance) for r in rows.collect()) == [
        ("TON", "0:A", "5"), ("TON", "0:B", "0")]
    stats = monitored.discovery_stats(docs, rows)
    assert {(r.asset_id, r.ok, r.holders) for r in stats.collect()} == {("TON", True, 2), ("TKN", False, 0)}
    with pytest.raises(Exception, match="all asset sources failed"):
        monitored.discovery_summary(stats.where(~F.col("ok"))).collect()


def test_jetton_excludes_zero_and_other_tokens(spark):
    from walletscope.sources import holders

    body = '{"jetton_wallets":[{"owner":"A","balance":"0"},{"owner":"B","balance":"' + "9" * 33 + '"}]}'
    docs = spark.createDataFrame([("0:m", body), ("0:other", body)], "master_address string, body string")
    tokens = spark.createDataFrame([("0:m", "TKN")], "master_address string, symbol string")
    rows = holders.holder_rows(holders.parse_jetton(docs, tokens)).collect()
    assert [(r.asset_id, r.address, r.balance) for r in rows] == [("TKN", "B", "9" * 33)]


def test_unreadable_source_is_recorded(spark):
    def broken(session, limit):
        return session.read.parquet("/nonexistent/holders")

    def fine(session, limit):
        return session.range(limit).toDF("n")

    found, problems = monitored.read_holder_sources(spark, {"x": broken, "y": fine}, 3)
    assert len(found) == 1 and list(problems) == ["x"]
    with pytest.raises(RuntimeError):
        monitored.read_holder_sources(spark, {"x": broken}, 3)


def test_ingest_result_five_error_three(spark):
    state = holdings(spark, ("a", "TON", "1", True), ("b", "TON", "1", True), ("c", "TON", "1", True))
    here, other = ("ton", "tonapi"), ("ever", "everapi")
    published = spark.createDataFrame(
        [("a", *here)] * 5 + [("c", *here)] * 3 + [("b", *here)] * 2 + [("a", *other), ("c", "ton", "everapi")],
        "address string, chain string, provider string")
    errors = spark.createDataFrame([("b", *here, "boom"), ("a", *other, "elsewhere")],
                                   "address string, chain string, provider string, error string")
    results = ingest.address_results(state, published, errors)
    assert tuple(ingest.ingest_result(results).first()) == (3, 8, 1)
    assert [(r.address, r.error) for r in ingest.failed_addresses(results).collect()] == [("b", "boom")]
    assert ingest.failed_address_lines(results).first().addresses == "b"
    assert ingest.events_ingested_total(results).first().events == 8
    assert ingest.events_ingested_total(results.where("events_published = 0")).count() == 0
