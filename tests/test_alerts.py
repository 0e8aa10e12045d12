import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from walletscope.operators import alerts
from walletscope.operators.checkpoints import checkpoint_conflicts
from walletscope.operators.handle import event_results, judge
from walletscope.operators.ingest import normalize_events
from walletscope.sources.pages import bad_pages, transactions

COLUMNS = ("event_id string, chain string, provider string, address string, lt bigint, tx_hash string, "
           "correlation_id string, raw_json string")


def events(spark, *documents):
    return spark.createDataFrame(
        [(f"e{i}", "ton", "tonapi", "0:TEST123", 1000, "hash", "c", d) for i, d in enumerate(documents)],
        COLUMNS)


def found(spark, document, **options):
    rows = alerts.whale_alerts(events(spark, document), **options).orderBy("position").collect()
    return [(r.direction, r.amount, r.message) for r in rows]


def status(spark, document):
    return alerts.evaluate(events(spark, document)).first()["status"]


def test_incoming(spark):
    doc = '{"in_msg":{"source":"0:SOURCE","destination":"0:DEST","value":"150000000000"}}'
    assert found(spark, doc) == [("IN", Decimal(150), "Received from 0:SOURCE")]


def test_outgoing(spark):
    doc = '{"out_msgs":[{"source":"0:SOURCE","destination":"0:DEST","value":"250000000000"}]}'
    assert found(spark, doc) == [("OUT", Decimal(250), "Sent to 0:DEST")]


def test_transactions_list(spark):
    doc = '{"transactions":[{"in_msg":{"value":"200000000000"}}]}'
    assert found(spark, doc) == [("IN", Decimal(200), "Received from unknown")]


def test_order_in_first_then_out(spark):
    doc = ('{"transactions":[{"out_msgs":[{"value":"150000000000"},{"value":"200000000000"}],'
           '"in_msg":{"value":"300000000000"}},{"in_msg":{"value":"400000000000"}}]}')
    assert [(d, int(a)) for d, a, _ in found(spark, doc)] == [
        ("IN", 300), ("OUT", 150), ("OUT", 200), ("IN", 400)]


VALUES = [
    ('"50000000000"', []), ('"99999999999"', []), ('"100000000000"', [Decimal(100)]),
    ("250000000000", [Decimal(250)]), ('""', []), ('"1e12"', []), ('"12.5"', []), ("1e12", []),
    ("true", []), ("{}", []), ("[200000000000]", []), ("null", []), ('" +200000000000 "', [Decimal(200)]),
    ('"-200000000000"', []), ('"123456789012345678901"', [Decimal("123456789012.345678901")])]


def judged(spark, documents):
    """Status, amounts and messages of each document, in one job."""
    rows = {r.event_id: r for r in alerts.evaluate(events(spark, *documents)).collect()}
    ordered = [rows[f"e{i}"] for i in range(len(documents))]
    return [(r.status, [h.amount for h in r.hits or []], [h.message for h in r.hits or []]) for r in ordered]


def test_values(spark):
    got = judged(spark, [f'{{"in_msg":{{"value":{value}}}}}' for value, _ in VALUES])
    for (value, amounts), (state, found_amounts, _) in zip(VALUES, got):
        assert (state, found_amounts) == ("ok", amounts), value


SOURCES = [
    ('{"workchain_id":0,"address":"EQD0vdQ_Nu12345"}', "0:EQD0vdQ_..."),
    ('{"workchain_id":-1,"address":"AB"}', "-1:AB"), ('{"workchain_id":0,"address":"0:AB"}', "0:AB"),
    ('{"address":"AB"}', "AB"), ('{"workchain_id":1.5,"address":"AB"}', "AB"),
    ('{"workchain_id":99999999999,"address":"AB"}', "AB"), ('{"raw_form":"RAW"}', "RAW"),
    ('{"address":"","raw_form":"RAW"}', "RAW"), ('{"address":5,"raw_form":"RAW"}', "RAW"),
    ('{"address":5}', "unknown"), ('{"raw_form":null}', "unknown"), ("{}", "unknown"), ("7", "unknown"),
    ("null", "unknown"), ("[]", "unknown"), ('"S"', "S")]


def test_addresses(spark):
    got = judged(spark, [f'{{"in_msg":{{"source":{source},"value":"150000000000"}}}}' for source, _ in SOURCES])
    for (source, text), (state, _, messages) in zip(SOURCES, got):
        assert (state, messages) == ("ok", [f"Received from {text}"]), source


STATES = [
    ("{ invalid json }", "raw_json_parse_error"), ("", "raw_json_parse_error"),
    ("   ", "raw_json_parse_error"), ('{"test": true} tail', "raw_json_parse_error"),
    ('{"a":1},{"b":2}', "raw_json_parse_error"), ("{'in_msg':{}}", "raw_json_parse_error"),
    ('{"in_msg":{"value":NaN}}', "raw_json_parse_error"), ('{"in_msg":{"value":1,}}', "raw_json_parse_error"),
    ('{"transactions":[{"in_msg":5}, oops]}', "raw_json_parse_error"), ("nul", "raw_json_parse_error"),
    ('[{"in_msg":}]', "raw_json_parse_error"),
    ("[]", "evaluation_error"), ("5", "evaluation_error"), ("null", "evaluation_error"),
    ('"text"', "evaluation_error"), ('{"transactions":5}', "evaluation_error"),
    ('{"transactions":null}', "evaluation_error"), ('{"transactions":[null]}', "evaluation_error"),
    ('{"transactions":[5]}', "evaluation_error"), ('{"in_msg":null}', "evaluation_error"),
    ('{"in_msg":5}', "evaluation_error"), ('{"out_msgs":null}', "evaluation_error"),
    ('{"out_msgs":{}}', "evaluation_error"), ('{"out_msgs":[null]}', "evaluation_error"),
    ('{"transactions":[{"in_msg":null}]}', "evaluation_error"),
    ('{"transactions":[{"out_msgs":[3]}]}', "evaluation_error"),
    ('{"in_msg":{"value":"' + "9" * 35 + '"}}', "evaluation_error"),
    ('{"in_msg":{"value":"-' + "9" * 35 + '"}}', "evaluation_error"),
    ('{"in_msg":{"value":"79228162514264337593543950336"}}', "evaluation_error"),
    ('{"in_msg":{"value":"150000000000","source":{"workchain_id":"0","address":"A"}}}', "evaluation_error"),
    ('{"in_msg":{"value":"150000000000","source":{"workchain_id":null,"address":"A"}}}', "evaluation_error"),
    ('{"in_msg":{"value":"150000000000","destination":{"raw_form":5}}}', "evaluation_error"),
    ('{"in_msg":{"value":"1","source":{"workchain_id":"0","address":"A"}}}', "ok"),
    ('{"test": true}', "ok"), ("{}", "ok"), ('{"transactions":[]}', "ok"), ('{"note":null}', "ok"),
    ('{"in_msg":{"value":"1","value":"150000000000"}}', "ok"), ('{"transactions":[],"in_msg":null}', "ok"), ('{"transactions":[],"in_msg":5,"out_msgs":{}}', "ok"),
    ('{"transactions":[{"in_msg":5}],"in_msg":5}', "evaluation_error")]


def test_document_status(spark):
    got = judged(spark, [document for document, _ in STATES])
    for (document, expected), (state, _, _) in zip(STATES, got):
        assert state == expected, document


def test_last_duplicate_key_wins(spark):
    assert [a for _, a, _ in found(spark, '{"in_msg":{"value":"1","value":"150000000000"}}')] == [Decimal(150)]
    doc = '{"in_msg":{"value":"150000000000","source":{"address":"A","address":"B","workchain_id":7}}}'
    assert [m for _, _, m in found(spark, doc)] == ["Received from 7:B"]


def test_all_or_nothing_per_event(spark):
    doc = ('{"transactions":[{"in_msg":{"value":"150000000000"}},'
           '{"in_msg":{"value":"150000000000","source":{"workchain_id":"x","address":"A"}}}]}')
    assert status(spark, doc) == "evaluation_error" and found(spark, doc) == []


def test_threshold_parameter(spark):
    doc = '{"in_msg":{"value":"1500000000"}}'
    assert found(spark, doc) == [] and len(found(spark, doc, threshold="1.5")) == 1


def test_decisions(spark):
    df = events(spark, '{"in_msg":{"value":"150000000000"},"out_msgs":[{"value":"200000000000"}]}',
                '{"test": true}', "{ invalid json }", "[]")
    at = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    rows = alerts.decisions(df, at).orderBy("event_id", "position").collect()
    assert [(r.event_id, r.outcome, r.reason_code, r.channel) for r in rows] == [
        ("e0", "sent", None, "console"), ("e0", "sent", None, "console"),
        ("e1", "suppressed", "no_qualifying_transfer", "none"),
        ("e2", "failed", "raw_json_parse_error", "none")]
    assert [r.event_id for r in alerts.failed_events(df).collect()] == ["e3"]


def test_decision_line_is_camel_case_without_nulls(spark):
    df = events(spark, '{"in_msg":{"value":"123450000000"}}', '{"test": true}')
    at = F.to_timestamp(F.lit("2024-01-31 01:02:03.000004"))
    lines = [json.loads(r.line) for r in alerts.decision_lines(
        alerts.decisions(df, at)).orderBy("event_id").collect()]
    assert lines[0]["timestamp"] == "2024-01-31T01:02:03.0000040+00:00"
    assert lines[0]["amount"] == 123.45 and lines[0]["assetId"] == "TON" and "reasonCode" not in lines[0]
    assert lines[1] == {"timestamp": "2024-01-31T01:02:03.0000040+00:00", "category": "whale_decision",
                        "outcome": "suppressed", "reasonCode": "no_qualifying_transfer",
                        "channel": "none", "eventId": "e1", "correlationId": "c", "chain": "ton",
                        "address": "0:TEST123", "provider": "tonapi"}


def test_alert_line(spark):
    doc = '{"in_msg":{"value":"150000000000","source":"0:SOURCE"}}'
    df = events(spark, doc).withColumn("address", F.lit("0:1234567890ABCDEF"))
    line = alerts.alert_lines(alerts.whale_alerts(df)).first()["line"]
    assert line == ("🐋 WHALE ALERT: TON - 0:12345678... IN 150 | Received from 0:SOURCE. "
                    "CorrelationId: c")


def page(spark, *txs, address="A"):
    body = json.dumps({"transactions": list(txs)})
    return spark.createDataFrame([("ton", "tonapi", address, body)],
                                 "chain string, provider string, address string, body string")


def tx(lt, value, **more):
    return {"lt": lt, "hash": f"h{lt}", "utime": 1700000000 + lt, "in_msg": {"value": str(value)}, **more}


def test_page_scope_multiplies_and_own_does_not(spark):
    pages = page(spark, tx(1, 150 * 10**9), tx(2, 200 * 10**9), tx(3, 1))
    whole = alerts.page_alerts(pages)
    own = alerts.page_alerts(pages, scope="own_tx")
    assert whole.count() == 3 * 2
    assert sorted((r.lt, int(r.amount)) for r in own.collect()) == [(1, 150), (2, 200)]


@pytest.mark.parametrize("scope", ["page", "own_tx"])
def test_page_alerts_equal_event_alerts(spark, scope):
    pages = page(spark, tx(1, 150 * 10**9), tx(2, 5), tx(3, 200 * 10**9,
                 out_msgs=[{"value": 300 * 10**9, "destination": "D"}]))
    events_df = (normalize_events(transactions(pages)).withColumn("correlation_id", F.lit(None).cast("string"))
                 .withColumn("lt", F.col("cursor.primary")).withColumn("tx_hash", F.col("cursor.secondary")))
    columns = ["event_id", "amount", "direction", "message", "position"]
    slow = sorted(map(tuple, alerts.whale_alerts(events_df, scope=scope).select(columns).collect()))
    fast = sorted(map(tuple, alerts.page_alerts(pages, scope=scope).select(columns).collect()))
    assert slow == fast and len(fast) == (9 if scope == "page" else 3)


def test_pages(spark):
    rows = page(spark, tx(12345, 1), tx(12346, 2)).unionByName(page(spark)).unionByName(
        spark.createDataFrame([("ton", "tonapi", "B", b) for b in (
            '{"transactions":null}', "{}", '{"transactions":[{"lt":1,"hash":"h"}]}',
            '{"transactions":[{"lt":"1","hash":"h","utime":1}]}', "oops", None, "", '{"transactions":[]} tail',
            '{"transactions":[]}{"transactions":[]}', '{"transactions":[]}],"z":[{}', "[]", "null")],
            "chain string, provider string, address string, body string"))
    got = normalize_events(transactions(rows)).orderBy("cursor.primary").collect()
    assert [(r.cursor.primary, r.cursor.secondary, r.address) for r in got] == [
        (12345, "h12345", "A"), (12346, "h12346", "A")]
    assert got[0].occurred_at == datetime(2023, 11, 15, 1, 39, 5) and len(got[0].event_id) == 16
    assert bad_pages(rows).count() == 10  # a null list is an empty page, a missing one is not


def test_conflicting_event_is_not_judged(spark):
    df = events(spark, '{"in_msg":{"value":"150000000000"}}', '{"in_msg":{"value":"150000000000"}}')
    outcomes = spark.createDataFrame(
        [("e0", "ton", "0:TEST123", 1000, "advance"), ("e1", "ton", "0:TEST123", 1000, "conflict")],
        "event_id string, chain string, address string, lt bigint, outcome string")
    rows = event_results(outcomes, judge(df, checkpoint_conflicts(outcomes))).orderBy("event_id").collect()
    assert [(r.status, r.alerts) for r in rows] == [("ok", 1), ("conflict", 0)]


def test_digits_written_as_escapes_still_count(spark):
    doc = '{"in_msg":{"v\\u0061lue":"\\u0031\\u00350000000000"}}'
    assert found(spark, doc.replace("00000000\"", "0000000000\"")) != []
    assert found(spark, '{"in_msg":{"value":"000000000000001"}}') == []
    assert len(found(spark, '{"in_msg":{"value":"-5"}}', threshold=-10)) == 1


def test_only_documents_that_can_qualify_are_searched(spark, monkeypatch):
    leaves = ['"0:PLAIN"', '{"address":"AB","workchain_id":-1}', '{"address":"","raw_form":"R"}', '{"address":"x:y","workchain_id":0}',
              '{"workchain_id":"0","address":"A"}', '{"raw_form":7}', "null", "[1]", "17"]
    values = ['"150000000000"', '"5"', '"\\u0031\\u00350000000000"', f'"{"9" * 40}"', f'"-{"9" * 29}"', '"99999999999"', "{}"]
    documents = [f'{{"in_msg":{{"source":{a},"value":{v}}},"out_msgs":[{{"destination":{a},"value":{v}}}]}}' for a in leaves for v in values]
    documents += ["{}", "[]", "{ bad", '{"out_msgs":[null]}', '{"transactions":[{"in_msg":{"value":"1"}}]}']
    plan = alerts.evaluate(events(spark, *documents))._jdf.queryExecution().optimizedPlan().toString()
    assert "[0-9]{12}" in plan
    for threshold in (100, 10**25):
        with monkeypatch.context() as m:
            some = sorted(map(repr, alerts.evaluate(events(spark, *documents), threshold).collect()))
            m.setattr(alerts, "_may_qualify", lambda raw, limit: F.lit(True))
            assert some == sorted(map(repr, alerts.evaluate(events(spark, *documents), threshold).collect()))


def test_few_conflicts_leave_the_documents_in_place(spark, monkeypatch):
    df = events(spark, *['{"in_msg":{"value":"150000000000"}}'] * 9)
    conflicts = spark.createDataFrame([("e3",), ("e5",)], "event_id string")
    monkeypatch.setattr("walletscope.operators.handle.evaluate", lambda rows, threshold: rows.withColumns(
        {"status": F.lit("ok"), "hits": F.lit(None)}))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, kind in ((2, "BroadcastHashJoin"), (1, "SortMergeJoin")):
            monkeypatch.setattr("walletscope.operators.handle.CONFLICT_IDS", most)
            kept = judge(df, conflicts)
            assert kind in kept._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.event_id for r in kept.collect()) == [f"e{i}" for i in (0, 1, 2, 4, 6, 7, 8)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
