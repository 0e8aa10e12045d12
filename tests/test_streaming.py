import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from walletscope.operators.checkpoints import checkpoint_conflicts, checkpoint_fold, final_checkpoints
from walletscope.operators.handle import event_results, judge
from walletscope.operators.ingest import first_arrival
from walletscope.sample import REDELIVERED, Sample
from walletscope.sinks import commits, messages as message_sink, tables
from walletscope.sinks.commits import Batch, batch_of, commit, entries, read, write
from walletscope.sinks.tables import (
    checkpoints_before, compact, read_checkpoints, read_events, read_state, stored_ids, write_states,
)
from walletscope.sources import messages
from walletscope.streaming import runs

SCHEMA = ("event_id string, chain string, address string, provider string, lt bigint, tx_hash string, "
          "block_time timestamp, raw_json string, correlation_id string, arrival_seq bigint, "
          "arrived_at timestamp")
START = datetime(2024, 1, 1)


def deliveries(n=240):
    rng = random.Random(4)
    rows = []
    for seq in range(n):
        lt, h = rng.randint(1, 60), rng.choice(["a", "a", "a", "b"])
        address = rng.choice(["A", "A", "B", "C"])
        doc = rng.choice(['{"in_msg":{"value":"%d"}}' % (rng.randint(50, 200) * 10**9), '{"test": true}',
                          "{ invalid json }", "[]"])
        at = START + timedelta(hours=lt)
        rows.append((f"{address}{lt}{h}", "ton", address, "tonapi", lt, h, at, doc, "c", seq, at))
    return rows


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Three files, to be taken one per micro-batch in arrival order."""
    root = str(tmp_path_factory.mktemp("landing"))
    rows = deliveries()
    for i in range(3):
        part = rows[i * 80:(i + 1) * 80]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(root)
    return root


def stream(spark, landing):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing))


def test_stream_of_three_batches_equals_one_batch(spark, landing, tmp_path):
    root = str(tmp_path)
    fixed = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    runs.run_available(stream(spark, landing), runs.handle(root, F.col("block_time"), fixed), f"{root}/log")
    whole = spark.createDataFrame(deliveries(), SCHEMA)
    fresh = first_arrival(whole).cache()
    fold = checkpoint_fold(fresh)
    expected = event_results(fold, judge(fresh, checkpoint_conflicts(fold)))
    got = runs.read_output(spark, root, "results")
    assert got.select("batch").distinct().count() == 3
    assert sorted(map(repr, got.drop("run", "batch").collect())) == sorted(map(repr, expected.collect()))
    marks = read_checkpoints(spark, root)
    assert sorted(map(repr, marks.collect())) == sorted(map(repr, final_checkpoints(fresh).collect()))
    assert read_events(spark, root).count() == fresh.count()


def test_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    rows = deliveries()
    step = runs.handle(root, F.col("block_time"), F.to_timestamp(F.lit("2024-02-01 00:00:00")), run="r")
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:100], rows[60:]))
    step(first, 0)
    step(second, 1)

    def state():
        shapes = {t: spark.read.parquet(f"{root}/{t}").drop("run", "batch", "attempt").schema.simpleString()[7:-1].replace(":", " ")
                  for t in ("events", "event_ids", "foreign_ids", "decisions", "checkpoints", "failed_events")} | runs.SHAPES
        return {t: sorted(map(repr, read(spark, root, t, shape).collect())) for t, shape in shapes.items()}

    before = state()
    step(second, 1)
    assert state() == before
    ids = [r.event_id for r in read_events(spark, root).collect()]
    assert ids and len(set(ids)) == len(ids)


def test_batch_of_copies_only(spark, tmp_path):
    root = str(tmp_path)
    rows = deliveries(40)
    step = runs.handle(root, F.col("block_time"), F.to_timestamp(F.lit("2024-02-01 00:00:00")), run="r")
    step(spark.createDataFrame(rows, SCHEMA), 0)
    step(spark.createDataFrame(rows, SCHEMA), 1)
    for table in ("results", "decisions", "events"):
        assert read(spark, root, table, "event_id string").where("batch = 1").count() == 0
    whole = first_arrival(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(repr, read_checkpoints(spark, root).collect())) == sorted(map(repr, final_checkpoints(whole).collect()))


def test_dedupe_store_is_exact_over_batches(spark, landing, tmp_path):
    root = str(tmp_path)
    runs.run_available(stream(spark, landing), runs.store_new(root, F.col("block_time")), f"{root}/log")
    kept = sorted(read_events(spark, root).select("event_id", "arrival_seq").collect())
    first = {}
    for row in deliveries():
        first.setdefault(row[0], row[9])
    assert [(r.event_id, r.arrival_seq) for r in kept] == sorted(first.items())


def test_bounded_dedupe_gives_each_id_once(spark, landing, tmp_path):
    root = str(tmp_path)
    runs.run_available(stream(spark, landing), runs.store_within(root), f"{root}/log")
    ids = [r.event_id for r in read_events(spark, root).collect()]
    assert sorted(ids) == sorted({r[0] for r in deliveries()})


def arrival(name, seq, day, lt=None, tx_hash="h", address="A"):
    at = START + timedelta(days=day)
    return (name, "ton", address, "tonapi", lt or seq, tx_hash, at, '{"test": true}', "c", seq, at)


def test_late_new_events_are_stored_and_near_copies_are_not(spark, tmp_path):
    root = str(tmp_path)
    step = runs.store_within(root, "1 day", run="r")
    batches = [[arrival("e1", 1, 10)], [arrival("e2", 2, 11), arrival("e1", 3, 10)],
               [arrival("late-new", 4, 1), arrival("e2", 5, 11)], [arrival("e3", 6, 12), arrival("late-new", 7, 1)]]
    for number, rows in enumerate(batches):
        step(spark.createDataFrame(rows, SCHEMA), number)
    assert sorted(r.event_id for r in read_events(spark, root).collect()) == ["e1", "e2", "e3", "late-new"]


def test_a_fresh_log_goes_on_with_what_is_stored(spark, tmp_path):
    root = str(tmp_path)
    for run, rows in (("a", [arrival("old", 1, 1, lt=5)]),
                      ("b", [arrival("old", 2, 1, lt=5), arrival("new", 3, 2, lt=4), arrival("rival", 4, 2, 5, "x")])):
        runs.handle(root, F.col("block_time"), run=run)(spark.createDataFrame(rows, SCHEMA), 0)
    assert sorted(r.event_id for r in read_events(spark, root).collect()) == ["new", "old", "rival"]
    assert {r.event_id: r.outcome for r in runs.read_output(spark, root, "results").collect()} == {
        "old": "advance", "new": "ignore", "rival": "conflict"}
    assert [(r.last_lt, r.last_hash) for r in read_checkpoints(spark, root).collect()] == [(5, "h")]
    assert [r.event_id for r in runs.read_output(spark, root, "conflicts").collect()] == ["rival"]


def test_streams_with_fresh_logs_keep_stored_events(spark, landing, tmp_path):
    root = str(tmp_path)
    for log in ("one", "two"):
        runs.run_available(stream(spark, landing), runs.store_new(root, F.col("block_time")), f"{root}/{log}")
        assert sorted(r.event_id for r in read_events(spark, root).collect()) == sorted({r[0] for r in deliveries()})


def test_arrivals_without_an_id_are_kept_apart(spark, tmp_path):
    root = str(tmp_path)
    rows = [arrival(None, 1, 1), arrival(None, 2, 1), arrival("e", 3, 1)]
    runs.handle(root, F.col("block_time"), run="r")(spark.createDataFrame(rows, SCHEMA), 0)
    assert [r.event_id for r in read_events(spark, root).collect()] == ["e"]
    assert read(spark, root, "unidentified", SCHEMA).count() == 2


def derived(name, seq, day, lt, tx_hash="h", address="A"):
    """An arrival whose id is the digest of its row."""
    row = arrival(name, seq, day, lt, tx_hash, address)
    return (hashlib.sha256(f"ton:{address}:{lt}:{tx_hash}".encode()).hexdigest()[:16], *row[1:])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_moved_checkpoints_are_written_and_only_near_ones_read(spark, tmp_path):
    root = str(tmp_path)
    many = [arrival(f"e{i}", i, 1, address=f"A{i}") for i in range(300)]
    step = runs.track(root, F.col("block_time"), run="r")
    step(spark.createDataFrame(many, SCHEMA), 0)
    one = spark.createDataFrame([arrival("f", 999, 2, address="A7"), arrival("e8", 1000, 2, address="A8")], SCHEMA)
    step(one, 1)
    assert [r.address for r in read(spark, root, "checkpoints", "address string").where("batch = 1").collect()] == ["A7"]
    assert "LeftSemi" in plan_of(checkpoints_before(one, root, Batch("r", 2)))
    assert {r.address: r.last_lt for r in checkpoints_before(one, root, Batch("r", 2)).collect()} == {"A7": 999, "A8": 8}


def test_a_base_takes_the_place_of_many_moves(spark, tmp_path):
    """After a base only its buckets and later moves are read, and a replay of the batch that wrote it changes nothing."""
    root = str(tmp_path)
    step = runs.track(root, F.col("block_time"), run="r")
    last = 4
    for number in range(last + 1):
        rows = [arrival(f"e{number}-{i}", 100 * number + i, 1, lt=10 * number + i, address=f"A{i % 20}") for i in range(40)]
        step(spark.createDataFrame(rows, SCHEMA), number)
    known = entries(spark, root)
    based = [e["batch"] for e in known if "checkpoint_base" in e["tables"]]
    assert based and len(based) < last
    one = spark.createDataFrame([arrival("f", 9999, 2, address="A7")], SCHEMA)
    before = checkpoints_before(one, root, Batch("r", last + 1))
    assert "bucket" in next(x for x in plan_of(before).splitlines() if "PartitionFilters" in x and "bucket" in x)
    folders = {f.split("/checkpoints/")[1].split("/attempt")[0] for f in before.inputFiles() if "/checkpoints/" in f}
    assert len(folders) <= last + 1 - max(based)
    top = {f"A{i % 20}": 10 * last + i for i in range(40)}
    assert {r.address: r.last_lt for r in read_checkpoints(spark, root).collect()} == top
    outcomes = sorted(map(repr, runs.read_output(spark, root, "outcomes").collect()))
    step(spark.createDataFrame(rows, SCHEMA), last)
    assert {r.address: r.last_lt for r in read_checkpoints(spark, root).collect()} == top
    assert sorted(map(repr, runs.read_output(spark, root, "outcomes").collect())) == outcomes


def test_id_lookup_reads_a_bounded_share_of_ten_thousand_batches(spark, tmp_path):
    """Batches whose lt spans do not meet the arrivals' are not read, however many there are."""
    root = str(tmp_path)
    step = runs.store_new(root, F.col("block_time"), run="r")
    for number in range(4):
        step(spark.createDataFrame([derived("", 100 * number + i, 1, lt=1000 * number + i) for i in range(50)], SCHEMA), number)
    real = sorted(entries(spark, root), key=lambda e: e["batch"])
    many = [Row(**{**real[0].asDict(), "batch": 10 + i, "spans": [Row(chain="ton", lo=10**6 + 10 * i, hi=10**6 + 10 * i + 9)]})
            for i in range(10_000)]
    arrivals = spark.createDataFrame([derived("", 1, 1, lt=2005), derived("", 2, 1, lt=2049), derived("", 3, 1, lt=7 * 10**7)], SCHEMA)
    found = stored_ids(arrivals, root, Batch("r", 99_999), [*real, *many])
    files = [f for f in found.inputFiles() if "/event_ids/" in f]
    assert files and all("/batch=2/" in f for f in files)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        scans = [x for x in plan_of(stored_ids(arrivals, root, Batch("r", 99_999), real)).splitlines() if "PushedFilters" in x]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("GreaterThanOrEqual(lt,2005)" in x.split("PushedFilters")[1] for x in scans)
    assert {r.event_id for r in found.collect()} >= {derived("", 1, 1, lt=t)[0] for t in (2005, 2049)}
    straggler = spark.createDataFrame([derived("", 1, 1, lt=3), derived("", 2, 1, lt=3049)], SCHEMA)
    batches = {f.split("/batch=")[1].split("/")[0] for f in stored_ids(straggler, root, Batch("r", 99_999), [*real, *many]).inputFiles() if "/event_ids/" in f}
    assert batches == {"0", "3"}


def test_an_id_that_is_no_digest_of_its_row_is_looked_up_everywhere(spark, tmp_path):
    root = str(tmp_path)
    step = runs.store_new(root, F.col("block_time"), run="r")
    genuine = derived("", 1, 1, lt=5)
    moved = (genuine[0], *arrival("", 2, 1, lt=9_000_000)[1:])  # the same id under another lt
    step(spark.createDataFrame([genuine], SCHEMA), 0)
    step(spark.createDataFrame([moved, arrival("odd", 3, 1, lt=7)], SCHEMA), 1)
    step(spark.createDataFrame([arrival("odd", 4, 1, lt=800), derived("", 5, 1, lt=6)], SCHEMA), 2)
    assert [(r.event_id, r.lt) for r in read_events(spark, root).orderBy("arrival_seq").collect()] == [
        (genuine[0], 5), ("odd", 7), (derived("", 0, 1, lt=6)[0], 6)]


def test_outside_a_stream_the_run_must_be_named(spark, tmp_path):
    rows = spark.createDataFrame([arrival("a", 1, 1)], SCHEMA)
    for make in (runs.store_new, runs.store_within, runs.track, runs.handle, runs.store_passed):
        with pytest.raises(ValueError, match="name the run"):
            make(str(tmp_path))(rows, 0)
    with pytest.raises(ValueError, match="names a folder"):
        runs.store_new(str(tmp_path), run="a/b")(rows, 0)
    for run in ("monday", "tuesday"):
        runs.store_new(str(tmp_path), F.col("block_time"), run=run)(spark.createDataFrame([arrival(run, 1, 1)], SCHEMA), 0)
    assert sorted(r.event_id for r in read_events(spark, str(tmp_path)).collect()) == ["monday", "tuesday"]


@pytest.mark.parametrize("broken", ["event_ids", "checkpoints", "results"])
def test_a_batch_that_dies_between_two_writes_leaves_nothing_to_see(spark, tmp_path, monkeypatch, broken):
    root = str(tmp_path)
    step = runs.handle(root, F.col("block_time"), F.to_timestamp(F.lit("2024-02-01 00:00:00")), run="r")
    step(spark.createDataFrame([arrival("a", 1, 1, lt=1)], SCHEMA), 0)
    second = spark.createDataFrame([arrival("b", 2, 1, lt=2)], SCHEMA)

    def dies(rows, root, table, batch, partition_by=(), also=None):
        if table == broken:
            raise RuntimeError("the driver is gone")
        return write(rows, root, table, batch, partition_by, also)

    with monkeypatch.context() as m:
        for module in (runs, tables):
            m.setattr(module, "write", dies)
        with pytest.raises(RuntimeError):
            step(second, 1)

    def seen():
        return ([r.event_id for r in read_events(spark, root).orderBy("event_id").collect()],
                [r.last_lt for r in read_checkpoints(spark, root).collect()],
                sorted(r.event_id for r in runs.read_output(spark, root, "results").collect()))

    assert seen() == (["a"], [1], ["a"])
    step(second, 1)
    assert seen() == (["a", "b"], [2], ["a", "b"])


def test_state_tables_change_at_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    marks = "chain string, address string, provider string, last_lt bigint, last_hash string, updated_at timestamp"
    held = "chain string, address string, provider string, asset_id string, balance string, is_active boolean, discovered_at timestamp, updated_at timestamp"

    def versions(n):
        return {"checkpoints": spark.createDataFrame([("ton", "A", "p", n, "h", START)], marks),
                "monitored_addresses": spark.createDataFrame([("ton", "A", "p", "x", str(n), True, START, START)], held)}

    def seen():
        return [[r[c] for r in read_state(spark, root, t).collect()] for t, c in (("checkpoints", "last_lt"), ("monitored_addresses", "balance"))]

    assert seen() == [[], []]
    write_states(root, versions(1))
    assert seen() == [[1], ["1"]]
    with monkeypatch.context() as m:
        m.setattr(tables, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            write_states(root, versions(2))
    assert seen() == [[1], ["1"]]
    write_states(root, versions(3))
    write_states(root, {"checkpoints": read_state(spark, root, "checkpoints").withColumn("last_lt", F.col("last_lt") + 1)})
    assert seen() == [[4], ["3"]]


def test_observed_metrics_equal_the_tables_of_each_batch(spark, tmp_path):
    root, rows = str(tmp_path), [*deliveries(120), arrival(None, 500, 1)]
    step = runs.handle(root, F.col("block_time"), F.to_timestamp(F.lit("2024-02-01 00:00:00")), run="r")
    for number, part in enumerate((rows[:60], rows[:60], rows[40:], [])):
        step(spark.createDataFrame(part, SCHEMA), number)
    got = {(r.batch, r.metric): r.value for r in runs.read_metrics(spark, root).collect()}
    assert len(got) == 4 * len(runs.OBSERVED)
    results = runs.read_output(spark, root, "results").collect()
    for number in range(4):
        mine = [r for r in results if r.batch == number]
        assert got[number, "events_stored"] == len(mine)
        for metric, outcome in (("checkpoints_advanced", "advance"), ("checkpoint_conflicts", "conflict"), ("checkpoints_ignored", "ignore")):
            assert got[number, metric] == sum(r.outcome == outcome for r in mine)
        assert got[number, "alerts_fired"] == sum(r.alerts for r in mine)
        assert got[number, "events_failed"] == sum(r.status == "evaluation_error" for r in mine)
        assert got[number, "events_unidentified"] == (number == 2)


def test_readers_open_two_eras_at_most(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(commits, "ERA", 4)
    for number in range(11):
        batch = batch_of(spark.range(0), number % 9, "r")
        write(spark.range(number, number + 1), root, "t", batch)
        commit(spark, root, batch, ["t"])
    assert len(commits._era_folders(spark, root)) == 2
    assert sorted(e["batch"] for e in entries(spark, root)) == list(range(9))
    assert sorted(r.id for r in read(spark, root, "t", "id bigint").collect()) == [2, 3, 4, 5, 6, 7, 8, 9, 10]


def test_watermark_state_and_exact_lookup_store_each_id_once(spark, tmp_path):
    """Copies inside the horizon, late copies, late new events, and a new log with an empty state."""
    root, landing = str(tmp_path / "out"), str(tmp_path / "in")
    waves = [[derived("", 1, 10, lt=1), derived("", 2, 11, lt=2), derived("", 3, 11, lt=2)],
             [derived("", 4, 30, lt=30), derived("", 5, 11, lt=2)],
             [derived("", 6, 30, lt=30), derived("", 7, 2, lt=7), derived("", 8, 10, lt=1), derived("", 9, 31, lt=31)],
             [derived("", 10, 31, lt=31), derived("", 11, 2, lt=7), derived("", 12, 60, lt=60), (None, *arrival("", 13, 1)[1:])]]
    sizes = []
    for number, rows in enumerate(waves):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
        query = (runs.within_watermark(source, "1 day").writeStream.foreachBatch(runs.store_passed(root, F.col("block_time")))
                 .option("checkpointLocation", f"{tmp_path}/log{number == 3}").trigger(availableNow=True).start())
        query.awaitTermination()
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    first = {}
    for row in sum(waves, []):
        if row[0] is not None:
            first.setdefault(row[0], row[9])
    assert {r.event_id: r.arrival_seq for r in read_events(spark, root).collect()} == first
    assert read_events(spark, root).count() == len(first) and max(sizes) <= 4


def contents(spark, root):
    """All that readers see below a root, without the batches' names."""
    kept = {"events": read_events(spark, root), "checkpoints": read_checkpoints(spark, root), "unidentified": read(spark, root, "unidentified", SCHEMA),
            **{t: runs.read_output(spark, root, t) for t in runs.SHAPES}}
    return {t: sorted(map(repr, df.drop("run", "batch").collect())) for t, df in kept.items()}


@pytest.mark.parametrize("broken", [None, "checkpoints"])
def test_compacted_tables_carry_on(spark, tmp_path, monkeypatch, broken):
    """With and without compactions readers see the same; one that dies changes nothing; replays stay replays."""
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    rows = deliveries(120 if broken else 200)
    parts = [rows[:60], [*rows[60:90], arrival(None, 1, 1)], rows[80:120], rows[100:160], rows[:200]]
    for number, part in enumerate(parts[:3] if broken else parts):
        for root in (plain, packed):
            run = "a" if number < 4 else "b"
            step = runs.handle(root, F.col("block_time"), run=run)
            step(spark.createDataFrame(part, SCHEMA), number)
            if number == 2:
                step(spark.createDataFrame(part, SCHEMA), number)
        if broken:
            continue
        compact(spark, packed, most=2)
        assert len(entries(spark, packed)) <= 3
    if broken:
        before = contents(spark, packed)

        def dies(rows, root, table, batch, partition_by=(), also=None):
            if table == broken:
                raise RuntimeError("the driver is gone")
            return write(rows, root, table, batch, partition_by, also)

        with monkeypatch.context() as m:
            m.setattr(tables, "write", dies)
            with pytest.raises(RuntimeError):
                compact(spark, packed, most=1)
        assert contents(spark, packed) == before and len(entries(spark, packed)) == 3
        assert compact(spark, packed, most=1)
    assert contents(spark, packed) == contents(spark, plain)


def test_large_compacted_batches_rest(spark, tmp_path):
    """A batch is copied again only when the younger ones have grown to its size; a base keeps its place."""
    root, sizes = str(tmp_path), []
    step = runs.track(root, F.col("block_time"), run="r")
    for number in range(7):
        rows = [derived("", 10 * number + i, 1, lt=100 * number + i, address=f"A{i % 3}") for i in range(9)]
        step(spark.createDataFrame(rows, SCHEMA), number)
        compact(spark, root, most=3)
        sizes.append(sorted(e["weight"] for e in entries(spark, root)))
        assert sum(sizes[-1]) == number + 1
    assert max(map(len, sizes)) <= 4
    assert read_events(spark, root).count() == 63
    assert {r.address: r.last_lt for r in read_checkpoints(spark, root).collect()} == {"A0": 606, "A1": 607, "A2": 608}
    copies = spark.createDataFrame([derived("", 999, 1, lt=203, address="A0"), derived("", 1000, 1, lt=207, address="A1")], SCHEMA)
    found = {r.event_id for r in stored_ids(copies, root, Batch("r", 99)).collect()}
    assert found >= {r.event_id for r in copies.collect()}


def test_checkpoint_stream_equals_batch(spark, landing, tmp_path):
    root = str(tmp_path)
    runs.run_available(stream(spark, landing), runs.track(root), f"{root}/log")
    got = read_checkpoints(spark, root).collect()
    whole = first_arrival(spark.createDataFrame(deliveries(), SCHEMA))
    assert sorted(map(repr, got)) == sorted(map(repr, final_checkpoints(whole).collect()))
    conflicts = checkpoint_conflicts(checkpoint_fold(whole.cache())).select("event_id").collect()
    assert sorted(runs.read_output(spark, root, "conflicts").select("event_id").collect()) == sorted(conflicts)


def test_messages_round_trip_and_problems(spark):
    rows = spark.createDataFrame(
        [("e1", "ton", "tonapi", "A", (1000, "h"), START + timedelta(microseconds=179575), '{"a":"b"}', None),
         ("e2", "ton", "tonapi", "A", (1001, "h"), START, "{ invalid json }", "given")],
        "event_id string, chain string, provider string, address string, "
        "cursor struct<primary: bigint, secondary: string>, occurred_at timestamp, raw_json string, "
        "correlation_id string")
    sent = message_sink.encode(rows).cache()
    back = messages.messages(sent.select("value")).orderBy("event_id").collect()
    assert [(r.event_id, r.cursor.primary, r.occurred_at, r.raw_json) for r in back] == [
        ("e1", 1000, START + timedelta(microseconds=179575), '{"a":"b"}'), ("e2", 1001, START, "{ invalid json }")]
    assert back[1].correlation_id == "given" and len(back[0].correlation_id) == 32
    bodies = spark.createDataFrame([("null",), ("oops",), ('{"event_id":"x"}',)], "value string")
    assert sorted(r.problem for r in messages.decode(bodies).collect()) == ["malformed", "malformed", "undecodable"]


def test_watermark_state_takes_ids_and_times_only(spark, tmp_path):
    schema = "event_id string, block_time timestamp, raw_json string"
    spark.createDataFrame([("a", datetime(2024, 1, 1), "{}")] * 2, schema).write.parquet(f"{tmp_path}/in")
    stream = runs.within_watermark(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    runs.append_available(stream, f"{tmp_path}/out", f"{tmp_path}/log")
    rows = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
    assert sorted((r.event_id, r.fresh, r.raw_json) for r in rows if not r.fresh) == [("a", False, "{}")] * 2
    assert [(r.event_id, r.raw_json) for r in rows if r.fresh] == [("a", None)]


def test_events_of_a_date_lie_in_few_files_without_adaptive_execution(spark, tmp_path):
    from walletscope.sinks import tables as table_sink
    from walletscope.sinks.commits import Batch

    rows = spark.range(0, 600, 1, 20).select(
        F.col("id").cast("string").alias("event_id"), F.lit("ton").alias("chain"), F.lit("a").alias("address"),
        F.lit("p").alias("provider"), F.col("id").alias("lt"), F.lit("h").alias("tx_hash"),
        F.timestamp_seconds(1704067200 + 86400 * (F.col("id") % 3)).alias("block_time"), F.lit("{}").alias("raw_json"),
        F.lit("c").alias("correlation_id"), F.col("id").alias("arrival_seq"), F.timestamp_seconds(F.lit(0)).alias("arrived_at"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = table_sink.write_events(rows, f"{tmp_path}", Batch("r", 0, "0", {}), F.col("block_time"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = list((tmp_path / "events").rglob("part-*.parquet"))
    assert stored.count() == 600 and len(files) <= 3 * table_sink.DATE_PARTS


def test_deliveries_are_chosen_before_documents_and_digests_are_made(spark, tmp_path):
    rows = [(lt, START + timedelta(hours=lt), lt % 7, kind, 1.5 * lt, "{}")
            for lt, kind in enumerate(["purchase", "click", "view", "signup", "error"] * 40)] + [(None, None, None, None, None, None)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    arrivals = Sample(spark, str(tmp_path)).arrivals()
    chosen = arrivals.where(F.col("arrival_seq") < 400)
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Filter"):]
    assert "sha2" in plan and "in_msg" in plan and "sha2" not in below and "in_msg" not in below
    seqs = sorted(r.arrival_seq for r in arrivals.collect() if r.lt is not None)
    assert seqs == sorted([lt * 4 for lt in range(200)] + [1, 97 * 4 + 1, 194 * 4 + 1] + [lt * 4 + REDELIVERED for lt in range(0, 200, 10)])
    of = {r.arrival_seq: r for r in chosen.collect()}
    digest = hashlib.sha256(b"97").hexdigest()[:16]
    assert (of[97 * 4].tx_hash, of[97 * 4 + 1].tx_hash, of[97 * 4].raw_json) == (digest, "x" + digest, of[97 * 4 + 1].raw_json)


def test_digests_of_stored_ids_are_made_once(spark, tmp_path, monkeypatch):
    plans = {}

    def noted(rows, root, table, batch, partition_by=(), also=None):
        plans[table] = rows._jdf.queryExecution().optimizedPlan().toString()
        return write(rows, root, table, batch, partition_by, also)

    monkeypatch.setattr(tables, "write", noted)
    nameless = list(derived("", 3, 1, lt=3))
    nameless[0], nameless[1] = hashlib.sha256(b":A:3:h").hexdigest()[:16], ""
    batches = [([derived("", 1, 1, lt=1), derived("", 2, 1, lt=2)], 0),
               ([derived("", 4, 1, lt=4), arrival("odd", 5, 1, lt=5)], 1), ([tuple(nameless), derived("", 6, 1, lt=6)], 1)]
    for number, (rows, foreign) in enumerate(batches):
        batch = Batch("r", number, f"a{number}", {})
        tables.write_events(spark.createDataFrame(rows, SCHEMA), str(tmp_path), batch, F.col("block_time"))
        assert (batch.seen["event_ids"], batch.seen["foreign_ids"]) == (2 - foreign, foreign)
        assert ("sha2" in plans["event_ids"]) == bool(foreign)


def test_tables_without_batches_are_known_to_be_empty(spark, tmp_path):
    rows = spark.createDataFrame(deliveries(), SCHEMA)
    none = read(spark, str(tmp_path), "event_ids", tables.ID_ROW)
    assert none.columns == ["event_id", "chain", "lt", "run", "batch"] and none.count() == 0
    assert "Join" not in rows.join(none.select("event_id"), "event_id", "left_anti")._jdf.queryExecution().optimizedPlan().toString()
