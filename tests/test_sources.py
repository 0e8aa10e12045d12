import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from walletscope import schemas
from walletscope.operators import alerts, diagnostics, monitored
from walletscope.operators.ingest import normalize_events
from walletscope.sinks import messages as message_sink, tables as sinks
from walletscope.sources import messages, pages, tables
from walletscope.sources.plugins import event_transactions
from walletscope.streaming import runs

START = datetime(2024, 1, 1)


def test_stored_tables_and_views(spark, tmp_path):
    root = str(tmp_path)
    rows = {
        "events": [("e1", "ton", "A", 1, "h", START, "{}", START), ("e2", "ton", "A", 2, "h", START, "{}", START)],
        "checkpoints": [("ton", "A", "tonapi", 2, "h", START)],
        "monitored_addresses": [("ton", "A", "tonapi", "TON", "9", True, START, START),
                                ("ton", "B", "tonapi", "TON", "10", True, START, START)],
        "address_leases": [("ton:tonapi:A", "w", START)],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, tables.TABLES[name]).write.parquet(f"{root}/{name}")
    read = {name: tables.read_table(spark, root, name) for name in rows}
    tables.register_views(read)
    assert spark.sql("select count(*) from events join checkpoints using (chain, address)").first()[0] == 2
    coverage = diagnostics.checkpoint_coverage(read["monitored_addresses"], read["checkpoints"]).first()
    assert tuple(coverage) == (2, 1, 1)
    waiting = diagnostics.unprocessed_addresses(read["monitored_addresses"], read["events"]).collect()
    assert [r.address for r in waiting] == ["B"]
    assert diagnostics.duplicate_event_ids(read["events"]).count() == 0
    numeric = diagnostics.top_balances(read["monitored_addresses"]).collect()
    text = diagnostics.top_balances(read["monitored_addresses"], mode="text").collect()
    assert [r.balance for r in numeric] == ["10", "9"] and [r.balance for r in text] == ["9", "10"]
    assert monitored.active_wallet_count(read["monitored_addresses"], rsd=0.05).first()[0] == 2


def test_coverage_may_be_negative(spark):
    held = spark.createDataFrame([("A", True)], "address string, is_active boolean")
    marks = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    assert diagnostics.checkpoint_coverage(held, marks).first().not_checkpointed == -2


def test_several_providers_repeat_an_asset(spark):
    rows = [("ton", "A", p, a, "1", True, START, START) for p, a in (("p1", "X"), ("p2", "X"), ("p1", "Y"))]
    held = spark.createDataFrame(rows, schemas.MONITORED_ADDRESSES)
    row = diagnostics.multi_asset_wallets(held).first()
    assert (row.asset_count, row.assets) == (2, "X, X, Y")


def test_page_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(3):
        body = json.dumps({"transactions": [{"lt": i * 10 + j, "hash": f"h{i}{j}", "utime": 1700000000,
                                             "in_msg": {"value": str(150 * 10**9)}} for j in range(4)]})
        line = {"chain": "ton", "provider": "tonapi", "address": f"A{i}", "body": body}
        (landing / f"{i}.json").write_text(json.dumps(line) + "\n")
    path, out = str(landing), str(tmp_path / "out")
    stream = pages.stream_pages(spark, path, files_per_batch=1)
    runs.append_available(normalize_events(pages.transactions(stream)), f"{out}/events", f"{out}/log")
    expected = normalize_events(pages.transactions(pages.read_pages(spark, path)))
    got = spark.read.parquet(f"{out}/events")
    assert expected.count() == 12
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_message_stream_from_text_files(spark, tmp_path):
    body = {"correlation_id": "c", "event_id": "e", "chain": "ton", "provider": "tonapi", "address": "A",
            "cursor": {"primary": 12345678, "secondary": "abc123def456"},
            "occurred_at": "2026-01-01T00:00:00Z", "raw_json": "{}"}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text(json.dumps(body) + "\nnull\noops\n")
    out = str(tmp_path / "out")
    runs.append_available(messages.messages(messages.stream_bodies(spark, str(folder))), f"{out}/rows",
                          f"{out}/log")
    row = spark.read.parquet(f"{out}/rows").first()
    assert (row.event_id, row.cursor.primary, row.occurred_at) == ("e", 12345678, datetime(2026, 1, 1))
    assert spark.read.parquet(f"{out}/rows").count() == 1


def test_sinks_get_the_alerts_of_each_batch(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"e{i}", "ton", "A", "tonapi", i, "h", START, '{"in_msg":{"value":"%d"}}' % (i * 60 * 10**9), "c",
             i, START) for i in range(1, 4)]
    arrivals = spark.createDataFrame(rows, (
        "event_id string, chain string, address string, provider string, lt bigint, tx_hash string, "
        "block_time timestamp, raw_json string, correlation_id string, arrival_seq bigint, arrived_at timestamp"))
    def small(judged):
        return alerts.alert_rows(judged).where("amount < 150")

    step = runs.handle(root, run="r", sinks=[sinks.line_sink(f"{root}/lines", alerts.alert_lines)],
                       rules={"whale": alerts.alert_rows, "small": small})
    for _ in range(2):  # a replay overwrites its own lines
        step(arrivals, 0)
        lines = sorted((r.rule, r.value) for r in spark.read.text(f"{root}/lines").collect())
        assert [r for r, _ in lines] == ["small", "whale", "whale"]
        assert " IN 120 | " in lines[0][1] and " IN 120 | " in lines[1][1] and " IN 180 | " in lines[2][1]


def test_event_sources_plug_in(spark):
    def first(session):
        return session.createDataFrame([("ton", "A")], "chain string, address string")

    def second(session):
        return session.createDataFrame([("B", "ever")], "address string, chain string")

    rows = event_transactions(spark, {"one": first, "two": second}).collect()
    assert sorted((r.chain, r.address) for r in rows) == [("ever", "B"), ("ton", "A")]


def test_duplicate_page_events_are_stored_once(spark, tmp_path):
    root = str(tmp_path)
    body = json.dumps({"transactions": [{"lt": 1, "hash": "h", "utime": 1700000000}]})
    page = spark.createDataFrame([("ton", "tonapi", "A", body)] * 2, pages.PAGE_FILE)
    events = normalize_events(pages.transactions(page)).select(
        "event_id", "chain", "address", "provider", F.col("cursor.primary").alias("lt"),
        F.col("cursor.secondary").alias("tx_hash"), F.col("occurred_at").alias("block_time"), "raw_json",
        F.lit("c").alias("correlation_id"), F.monotonically_increasing_id().alias("arrival_seq"),
        F.col("occurred_at").alias("arrived_at"))
    step = runs.store_new(root, run="r")
    step(events, 0)
    step(events, 1)
    assert sinks.read_events(spark, root).count() == 1


BROKEN = [None, "", " ", "null", "oops", "{} tail", "{},{}", '{}],"z":[1', '{}],"end":"x"},{"doc":[{}', '[1', '{"a":}']


def test_one_strict_document(spark):
    from walletscope.sources.documents import with_document

    texts = [(i, t) for i, t in enumerate(BROKEN + ['{"a":1}', ' {"a":2, "b":[{}]}\n', "{}"])]
    read = with_document(spark.createDataFrame(texts, "i int, t string"), "t", "struct<a: int>", "doc")
    assert read.columns == ["i", "t", "doc"]
    got = {r.i: r.doc and r.doc.a for r in read.collect() if r.doc is not None}
    assert got == {len(BROKEN): 1, len(BROKEN) + 1: 2, len(BROKEN) + 2: None}


def test_broken_holder_documents_are_unreadable(spark):
    from walletscope.sources import holders

    good = ['[{"account":"A","balance":"1"}]', "[]"]
    native = holders.parse_native(spark.createDataFrame(
        [(b,) for b in BROKEN + good + [good[0] + ',[]', good[0] + ' tail', '[],"z":[1]']], "body string"))
    assert native.filter("readable").count() == 2
    token = [('{"jetton_wallets":[{"owner":"A","balance":"1"}]}')]
    jetton = holders.parse_jetton(
        spark.createDataFrame([("0:x", b) for b in [None, "", "null", token[0] + " tail", *token]], "master_address string, body string"),
        spark.createDataFrame([("0:x", "X")], "master_address string, symbol string"))
    assert [(r.readable, len(r.holders or [])) for r in jetton.collect()].count((True, 1)) == 1
    assert jetton.filter("readable").count() == 1


def test_broken_bodies_become_attempts_and_dead_letters(spark):
    from walletscope.operators.retries import dead_letters

    bodies = [("q", "m1", "null")] + [("q", "m2", "oops")] * 3 + [("q", "m3", "{} tail")] + [("q", "m4", None)]
    attempts = messages.failed_attempts(spark.createDataFrame(bodies, "queue string, message_id string, value string"))
    got = {r.message_id: (r.attempts, r.disposition, r.reason) for r in dead_letters(attempts).collect()}
    assert got == {"m1": (1, "dead", "undecodable"), "m2": (3, "dead", "max_retries"), "m3": (1, "retry", None),
                   "m4": (1, "retry", None)}


def test_published_files_are_small_whatever_the_messages_repeat(spark, tmp_path, monkeypatch):
    """Messages of a page all carry its body; what is written grows with the bodies that differ."""
    monkeypatch.setattr(message_sink, "FILE_ROWS", 40)
    body = "".join(f'{{"lt":{i * 7919 % 100003}}},' for i in range(500))
    rows = spark.range(100, numPartitions=1).select(
        F.col("id").cast("string").alias("message_id"), F.lit("c").alias("correlation_id"),
        F.lit("application/json").alias("content_type"), F.concat(F.lit(body), F.col("id")).alias("value"))
    message_sink.write_files(rows, f"{tmp_path}/out")
    files = list((tmp_path / "out").glob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 10 * len(body)
    back = spark.read.schema("message_id string, correlation_id string, content_type string, value string").json(f"{tmp_path}/out")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
