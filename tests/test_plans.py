"""Shapes the plans must keep: what is shuffled, scanned, broadcast and parsed."""

import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    old = spark.conf.get("spark.sql.maxPlanStringLength"), spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", old[0])
        spark.conf.set("spark.sql.debug.maxToStringFields", old[1])


@pytest.mark.parametrize("name", ["whale_alerts", "decisions", "snk_alert_lines", "snk_decision_log",
                                  "message_addresses", "json_shape", "event_ids", "large_transfers"])
def test_row_work_has_no_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


@pytest.mark.parametrize("name", ["whale_alerts", "decisions", "page_alerts", "json_shape", "alerts_fired_total"])
def test_documents_are_parsed_once(spark, name):
    lines = plan(spark, name).splitlines()
    assert not [line for line in lines if re.search(r"\bFilter\b", line) and "from_json" in line]


@pytest.mark.parametrize("name", ["whale_alerts", "decisions", "json_shape"])
def test_no_reading_of_a_document_is_repeated(spark, name):
    """Four ways of reading at most, wherever in the plan: typed, list alone, loose, untyped."""
    text = plan(spark, name)
    assert 1 <= len(re.findall(r"from_json\(", text)) <= 4


@pytest.mark.parametrize("name", ["first_arrival", "limit_per_group", "top_balances_per_asset",
                                  "fetch_after_checkpoint", "new_events", "all_asset_holders"])
def test_limits_are_applied_before_the_shuffle(spark, name):
    lines = plan(spark, name).splitlines()
    partial = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    final = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Final" in line]
    assert partial and final and min(final) < min(partial)


@pytest.mark.parametrize("name", ["unprocessed_addresses", "unprocessed_wallets", "new_events"])
def test_missing_rows_are_anti_joins(spark, name):
    text = plan(spark, name)
    assert "LeftAnti" in text and "LeftOuter" not in text


@pytest.mark.parametrize("name", [
    "checkpoint_fold", "hold_for", "fetch_after_checkpoint", "ingest_cycle", "upsert_monitored",
    "system_summary", "checkpoint_coverage", "notification_schedule", "failed_address_lines", "health_bands"])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name,columns", [
    ("event_count", set()), ("events_per_address_top10", {"user_id"}),
    ("checkpoint_timestamps", {"user_id", "ts", "event_id"}),
    ("rule_ingestion_stalled", {"event_id", "ts"})])
def test_scans_read_only_what_is_needed(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    read = {field.split(":")[0] for schema in schemas for field in schema.split(",") if field}
    assert read <= columns


def test_time_cut_reaches_the_scan(spark):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(spark, "new_events"))
    assert any("LessThan(ts" in text for text in pushed)


def test_sliced_window_is_partitioned_by_slice(spark):
    text = plan(spark, "checkpoint_fold")
    assert re.search(r"Exchange hashpartitioning\(chain#\d+, address#\d+, provider#\d+, _slice#\d+L?, \d+\), "
                     r"REPARTITION_BY_COL", text)


def test_colocated_fetch_shuffles_nothing(spark):
    text = plan(spark, "fetch_colocated")
    assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text


def test_sketches_are_merged_and_rows_are_not_read_again(spark, tmp_path):
    from pyspark.sql import functions as F

    from walletscope.operators import sketches

    rows = spark.range(200_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50_000).alias("a"),
                                       F.timestamp_seconds(F.col("id") * 20).alias("at"))
    sketches.daily(rows, ["k"], "at", ["a"]).write.parquet(f"{tmp_path}/days")
    days = spark.read.parquet(f"{tmp_path}/days")
    assert days.count() <= 3 * 47
    since = F.to_date(F.lit("1970-01-20"))
    for some, kept in ((None, rows), (F.col("day") >= since, rows.where(F.to_date("at") >= since))):
        got = {r.k: r for r in sketches.merged(days, ["k"], ["a"], some).collect()}
        for r in kept.groupBy("k").agg(F.count_distinct("a").alias("n"), F.count("*").alias("rows"), F.min("at").alias("first")).collect():
            assert abs(got[r.k].a_estimate - r.n) <= sketches.error_bound() * r.n
            assert (got[r.k].rows, got[r.k].first_at) == (r.rows, r["first"])
    assert sketches.merged(days.limit(0), ["k"], ["a"]).count() == 0


@pytest.mark.parametrize("bits", [3, 14])
@pytest.mark.parametrize("values", [
    [5], [None, 2, 2, 9], [-7, 3, 3, 3, 100], [*range(1000), *[17] * 500, 10 ** 12, None], [-2 ** 63, -1, 0, 4, 2 ** 63 - 1]])
def test_percentiles_equal_those_of_one_task(spark, values, bits):
    from pyspark.sql import functions as F

    from walletscope.plans.ranks import percentiles

    df, shares = spark.createDataFrame([(v,) for v in values], "lt bigint"), (0.0, 0.3, 0.5, 0.8, 1.0)
    expected = df.agg(F.percentile("lt", F.array(*map(F.lit, shares)))).first()[0]
    assert percentiles(df, "lt", shares, bits) == pytest.approx(expected)


def test_percentiles_of_nothing(spark):
    from walletscope.plans.ranks import percentiles

    assert percentiles(spark.createDataFrame([(None,)], "lt bigint"), "lt", (0.3,)) == [None]
