"""Alerts from shredded documents are those of the texts."""

import json
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_random_documents import COLUMNS, Maker

from walletscope.operators import alerts, stored_documents


def stored(spark, events, tmp_path):
    stored_documents.store(events, str(tmp_path / "stored"))
    return stored_documents.read_stored(spark, str(tmp_path / "stored"), events.schema)


def events(spark, texts):
    return spark.createDataFrame([(str(i), "ton", "tonapi", "A", 1, "h", "c", t) for i, t in enumerate(texts)], COLUMNS)


def judged(df):
    return {r.event_id: (r.status, [tuple(h) for h in r.hits or []]) for r in df.collect()}


def alerted(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("threshold", [100, "0.5", 0, -200])
def test_random_documents(spark, tmp_path, threshold):
    maker = Maker(77)
    texts = [maker.delivered()[0] for _ in range(4000)]
    df = events(spark, texts)
    back = stored(spark, df, tmp_path)
    assert 1000 < back.where("document is not null").count() < 4000
    assert back.where("document is null and odd_json is distinct from raw_json or document is not null and odd_json is not null").count() == 0
    assert judged(stored_documents.evaluate_stored(back, threshold)) == judged(alerts.evaluate(df, threshold))
    assert alerted(stored_documents.stored_alerts(back, threshold)) == alerted(alerts.whale_alerts(df, threshold))


ODD = [None, "", " ", "null", "{}", "[]", "{} {}", "{} tail", '{"in_msg":null}', '{"transactions":null}',
       '{"transactions":[null]}', '{"out_msgs":[null]}', '{"in_msg":{"value":null}}', '{"in_msg":{"value":"-0"}}',
       '{"in_msg":{"value":-0}}', '{"in_msg":{"value":99999999999999999999}}', '{"in_msg":{"value":150000000000.0}}',
       '{"in_msg":{"value":"5"},"in_msg":{"value":"500000000000"}}', '{"In_Msg":{"value":"500000000000"}}',
       '{"in_msg":{"value":"500000000000","source":null}}', '{"in_msg":{"value":"\\u0035\\u003000000000000"}}',
       '{"in_msg":{"value":"79228162514264337593543950335"}}', '{"in_msg":{"value":"79228162514264337593543950336"}}',
       '{"in_msg":{"value":"-79228162514264337593543950336"}}', '{"in_msg":{"value":"' + "1" * 60 + '"}}',
       '],"z":[1', json.dumps({"transactions": [{"in_msg": {"value": "200000000000"}}] * 3000})]


def test_odd_documents_and_empty_tables(spark, tmp_path):
    df = events(spark, ODD + ODD[-2:]).withColumn("Document", F.lit("own")).withColumn("_doc2", F.lit(1))
    back = stored(spark, df, tmp_path)
    assert judged(stored_documents.evaluate_stored(back)) == judged(alerts.evaluate(df))
    nothing = tmp_path / "none"
    nothing.mkdir()
    assert stored_documents.stored_alerts(stored(spark, df.limit(0), nothing)).count() == 0


def test_alerts_read_message_columns_only(spark, tmp_path):
    texts = [json.dumps({"transactions": [{"lt": i, "hash": f"{i:064}", "account": {"name": f"n{i}" * 20},
                                           "in_msg": {"value": str(i * 10**9), "source": {"address": f"S{i}"}}}]})
             for i in range(2000)]
    back = stored(spark, events(spark, texts), tmp_path)
    found = stored_documents.stored_alerts(back)
    assert found.count() == 1900
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = spark._jvm.PythonSQLUtils.explainString(stored_documents.stored_alerts(back)._jdf.queryExecution(), "formatted")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "GreaterThanOrEqual(largest_nano," in plan
    assert "raw_json" not in scan and "document:struct<" in scan
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in glob(str(tmp_path / "stored" / "*.parquet"))]
    columns = [g.column(i) for g in groups for i in range(g.num_columns)]
    assert any(c.path_in_schema.endswith("in_msg.typed_value.value.typed_value") for c in columns)
    text = sum(c.total_uncompressed_size for c in columns if c.path_in_schema == "raw_json")
    leaves = sum(c.total_uncompressed_size for c in columns if ".in_msg." in c.path_in_schema)
    assert leaves * 2 < text
