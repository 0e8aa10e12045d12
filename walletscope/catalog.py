"""The registered queries: every operator over the views of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from walletscope import functions as fn, params
from walletscope.operators import (
    alerts, checkpoints, diagnostics, gauges, handle, ingest, lag, metrics, monitored, rates, retries,
    rules, sketches, stored_documents,
)
from walletscope.plans.ranks import percentiles
from walletscope.plans.settle import settle
from walletscope.sample import (
    AS_OF, CUT, OTHER_ASSET, OTHER_CHAIN, OTHER_PROVIDER, REDELIVERED, Sample, address, arrivals_from_events, as_of, asset_wallet,
    events_from_tx, tx_from_events,
)
from walletscope.schemas import METRIC_SAMPLES, MONITORED_KEY, WALLET
from walletscope.session import shared_dir
from walletscope.sinks import colocated, commits, messages as message_sink, tables as table_sink
from walletscope.sources import holders, landing, messages, pages, plugins, tables
from walletscope.streaming import counters, keyed, runs, stalls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def present(df: DataFrame) -> DataFrame:
    """Portable result types: UTC times without zone, exact decimals as text, bigints."""
    def plain(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return col.cast("bigint").alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str):
    def register(build: Callable[[Sample], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(Sample(spark, sf_dir)))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        return build

    return register


# ---- sources -----------------------------------------------------------------

def _damaged(docs: DataFrame, *others: str) -> DataFrame:
    """Each document followed by texts that are no document: all of them must count for nothing."""
    body = F.col("body")
    texts = F.array(body, F.concat(body, F.lit(" tail")), F.concat(body, F.lit(","), body), F.concat(body, F.lit('],"z":[1')),
                    F.lit(""), F.lit("null"), F.lit(None), *(F.lit(o) for o in others))
    return docs.withColumn("body", F.explode(texts))


@query("src_tx_pages")
def _(s: Sample) -> DataFrame:
    return pages.transactions(_damaged(s.tx_pages(), "{}", '{"transactions":null}')).drop("body")


@query("bad_pages")
def _(s: Sample) -> DataFrame:
    """How many texts of each wallet are no page."""
    bad = pages.bad_pages(_damaged(s.tx_pages(), "{}", '{"transactions":null}'))
    return bad.groupBy(*WALLET).agg(F.count(F.lit(1)).alias("bad"), F.count("body").alias("with_text"))


@query("event_sources")
def _(s: Sample) -> DataFrame:
    """Transactions of two event sources behind one plug-in point: a landing zone of pages, and documents made on the way."""
    root = shared_dir(s.spark, "landing")
    _damaged(s.tx_pages(), "{}").where(F.col("chain") != OTHER_CHAIN).drop("page_no").write.parquet(root)
    made = {"landing": lambda spark: pages.transactions(spark.read.schema(pages.PAGE_FILE).parquet(root)),
            "direct": lambda spark: pages.transactions(s.tx_pages().where(F.col("chain") == OTHER_CHAIN).drop("page_no"))}
    return plugins.event_transactions(s.spark, made).drop("body")


def _land(s: Sample, root: str, landed: DataFrame, drops: range) -> None:
    """Pages, whole and damaged, as drops: first pages, second pages, and all others."""
    for drop in drops:
        mine = F.least(F.col("page_no"), F.lit(2)) == drop
        landing.land(_damaged(landed.where(mine), "{}").drop("page_no"), root, drop)


@query("src_landed_pages")
def _(s: Sample) -> DataFrame:
    """Transactions of a landing zone of three drops, read through its data source."""
    root = shared_dir(s.spark, "landed")
    _land(s, root, settle(s.tx_pages(), "pages"), range(3))
    return pages.transactions(landing.read_landed(s.spark, root)).drop("body")


@query("src_landed_pages_stream")
def _(s: Sample) -> DataFrame:
    """The same as a stream that stops after the first drop and goes on with the others."""
    root = shared_dir(s.spark, "landed")
    whole = settle(s.tx_pages(), "pages")
    for drops in (range(1), range(1, 3)):
        _land(s, f"{root}/zone", whole, drops)
        rows = pages.transactions(landing.stream_landed(s.spark, f"{root}/zone")).drop("body")
        runs.append_available(rows, f"{root}/out", f"{root}/log")
    return s.spark.read.parquet(f"{root}/out")


@query("src_landed_pages_after")
def _(s: Sample) -> DataFrame:
    """What one wallet has after a cursor: the source opens the wallet's buckets and skips pages behind the cursor."""
    root = shared_dir(s.spark, "landed")
    _land(s, root, settle(s.tx_pages(), "pages"), range(3))
    return landing.fetch_after(s.spark, root, "ton", "0:000007", "tonapi", 300).drop("body")


@query("holder_sources")
def _(s: Sample) -> DataFrame:
    """Top holders of all holder sources behind one plug-in point; one that cannot be read is left out."""
    made = {"native": lambda spark, limit: settle(holders.parse_native(s.native_docs()), "native"),
            "jetton": lambda spark, limit: settle(holders.parse_jetton(s.jetton_docs(), s.tokens()), "jetton"),
            "gone": lambda spark, limit: spark.read.parquet(f"{shared_dir(spark, 'gone')}/nothing")}
    found, problems = monitored.read_holder_sources(s.spark, made, params.TOP_HOLDERS_LIMIT)
    if set(problems) != {"gone"}:
        raise RuntimeError(f"unexpected problems: {problems}")
    return monitored.all_asset_holders(found)


@query("src_native_holders")
def _(s: Sample) -> DataFrame:
    return holders.holder_rows(holders.parse_native(_damaged(s.native_docs(), "{}")))


@query("src_jetton_holders")
def _(s: Sample) -> DataFrame:
    rows = holders.holder_rows(holders.parse_jetton(_damaged(s.jetton_docs(), "[]"), s.tokens()))
    return ingest.limit_per_group(rows, ["asset_id"], monitored.by_value(), params.TOP_HOLDERS_LIMIT)


@query("src_event_messages")
def _(s: Sample) -> DataFrame:
    """Bodies of every event as a stream, decoded and written; damaged bodies are no messages."""
    bodies = s.message_bodies(events_from_tx(tx_from_events(s.stream("events")))).select("value")
    root = shared_dir(s.spark, "messages")
    runs.append_available(messages.messages(bodies), f"{root}/out", f"{root}/log")
    return (s.spark.read.parquet(f"{root}/out")
            .select("*", F.col("cursor.primary").alias("lt"), F.col("cursor.secondary").alias("tx_hash"))
            .drop("cursor"))


def _stored(s: Sample, df: DataFrame, name: str) -> DataFrame:
    """A view written as the stored table it stands for, and read as such."""
    root = shared_dir(s.spark, "tables")
    df.write.parquet(f"{root}/{name}")
    return tables.read_table(s.spark, root, name)


@query("src_tables")
def _(s: Sample) -> DataFrame:
    """Rows of each of the four tables, stored and read back, in one listing of their keys."""
    views = {"events": s.stored_events(), "checkpoints": s.checkpoints(), "monitored_addresses": s.monitored(),
             "address_leases": s.leases()}
    stored = {name: _stored(s, df, name) for name, df in views.items()}
    parts = {
        "events": stored["events"].select(F.col("event_id").alias("key"), "chain", "address"),
        "checkpoints": stored["checkpoints"].select(F.concat_ws(":", *WALLET).alias("key"), "chain", "address"),
        "monitored_addresses": stored["monitored_addresses"].select(
            F.concat_ws(":", *MONITORED_KEY).alias("key"), "chain", "address"),
        "address_leases": stored["address_leases"].select(
            F.col("lease_key").alias("key"), fn.lease_parts("lease_key").alias("p")).select("key", "p.chain", "p.address"),
    }
    return reduce(DataFrame.unionByName,
                  [df.withColumn("table_name", F.lit(name)) for name, df in parts.items()])


@query("src_metric_samples")
def _(s: Sample) -> DataFrame:
    read = _stored(s, s.samples(), "metric_samples")
    return read.select("metric", gauges.series_key(F.col("labels")).alias("series"), "ts", "value")


# ---- sinks -------------------------------------------------------------------

@query("snk_event_messages")
def _(s: Sample) -> DataFrame:
    """Every event published as a JSON line and read back; of the random ids only the width shows."""
    sent = ingest.normalize_events(pages.transactions(s.tx_pages())).withColumn(
        "correlation_id", F.lit(None).cast("string"))
    root = shared_dir(s.spark, "published")
    message_sink.write_files(message_sink.encode(sent), root)
    back = s.spark.read.schema(
        "message_id string, correlation_id string, content_type string, value string").json(root)
    body = messages.messages(back.select("value"))
    return body.select("event_id", "chain", "provider", "address", "occurred_at",
                       F.col("cursor.primary").alias("lt"), "raw_json",
                       F.length("correlation_id").alias("correlation_width"))


@query("snk_events")
def _(s: Sample) -> DataFrame:
    """All deliveries through the idempotent event sink, twice and from two runs."""
    root = shared_dir(s.spark, "events")
    for run, number in (("one", 0), ("one", 1), ("one", 1), ("two", 0)):
        runs.store_new(root, created_at=F.col("block_time"), run=run)(s.arrivals(), number)
    return (table_sink.read_events(s.spark, root)
            .select("event_id", "chain", "address", "lt", "tx_hash", "block_time", "raw_json", "created_at"))


@query("snk_state_tables")
def _(s: Sample) -> DataFrame:
    """Two versions of the checkpoint table: as stored earlier, then folded with all arrivals."""
    root = shared_dir(s.spark, "state")
    table_sink.write_states(root, {"checkpoints": s.checkpoints(CUT)})
    stored = table_sink.read_state(s.spark, root, "checkpoints")
    table_sink.write_states(root, {"checkpoints": checkpoints.final_checkpoints(s.arrivals(), stored)})
    return table_sink.read_state(s.spark, root, "checkpoints")


@query("snk_monitored")
def _(s: Sample) -> DataFrame:
    """Two versions of the monitored table: as stored, then with the discovered holders."""
    root = shared_dir(s.spark, "monitored")
    table_sink.write_states(root, {"monitored_addresses": s.monitored(), "checkpoints": s.checkpoints(CUT)})
    stored = table_sink.read_state(s.spark, root, "monitored_addresses")
    table_sink.write_states(root, {"monitored_addresses": monitored.upsert_monitored(stored, _discoveries(s), as_of())})
    return table_sink.read_state(s.spark, root, "monitored_addresses")


@query("snk_alert_lines")
def _(s: Sample) -> DataFrame:
    return (alerts.alert_lines(alerts.whale_alerts(s.chain_events()))
            .select("event_id", "position", "line"))


@query("snk_decision_log")
def _(s: Sample) -> DataFrame:
    lines = alerts.decision_lines(alerts.decisions(s.chain_events(), as_of()))
    return lines.select("event_id", "position", "line")


@query("snk_metric_samples")
def _(s: Sample) -> DataFrame:
    """One collection cycle: all counters and gauges as sample rows."""
    held, marks = s.monitored(), s.checkpoints()
    cycle = ingest.address_results(held, s.chain_events(), _cycle_errors(s))
    rows = metrics.metric_snapshot(
        as_of(), ingested=ingest.events_ingested_total(cycle),
        alerts=metrics.alerts_fired_total(alerts.whale_alerts(s.chain_events())),
        lag=lag.event_lag(marks, as_of()), stale=lag.stale_wallets_by_chain(marks, as_of()),
        dead=retries.dlq_depth(retries.dead_letters(s.attempts())),
        wallets=monitored.active_wallet_count(held),
        breaker=metrics.breaker_state(s.samples().where(F.col("metric") == "circuit_breaker_state")),
        discovery=metrics.discovery_last_success(held))
    root = shared_dir(s.spark, "metrics")
    cycle = commits.batch_of(rows, 0, "cycle")
    commits.write(rows, root, "samples", cycle)
    commits.commit(s.spark, root, cycle, ["samples"])
    return (commits.read(s.spark, root, "samples", METRIC_SAMPLES)
            .select("metric", gauges.series_key(F.col("labels")).alias("series"), "ts", "value"))


# ---- projections and filters ---------------------------------------------------

@query("normalize_events")
def _(s: Sample) -> DataFrame:
    return (ingest.normalize_events(pages.transactions(s.tx_pages()))
            .select("event_id", "chain", "provider", "address", F.col("cursor.primary").alias("lt"),
                    F.col("cursor.secondary").alias("tx_hash"), "occurred_at", "raw_json"))


@query("events_to_rows")
def _(s: Sample) -> DataFrame:
    return ingest.events_to_rows(ingest.normalize_events(pages.transactions(s.tx_pages()))).drop("raw_json")


@query("decisions")
def _(s: Sample) -> DataFrame:
    return alerts.decisions(s.chain_events(), as_of())


@query("active_addresses")
def _(s: Sample) -> DataFrame:
    return monitored.active_addresses(s.monitored())


@query("large_transfers")
def _(s: Sample) -> DataFrame:
    """Transactions whose own value reaches the threshold."""
    amount = fn.units(F.col("value_nano").cast("string"))
    return (s.chain_tx().withColumn("amount", amount)
            .where(F.col("amount") >= params.ALERT_THRESHOLD).select("lt", "chain", "address", "amount"))


@query("after_cursor")
def _(s: Sample) -> DataFrame:
    return (ingest.after_cursor(s.chain_tx(), s.checkpoints(CUT))
            .select(*WALLET, "lt", "tx_hash", "block_time"))


@query("active_leases")
def _(s: Sample) -> DataFrame:
    return diagnostics.active_leases(s.leases(), as_of())


def _cycle_errors(s: Sample) -> DataFrame:
    """Wallets of customers in debt could not be fetched in this cycle; every third on the other chain only."""
    other = F.col("c_custkey") % 3 == 0
    return (s.table("customer").where(F.col("c_acctbal") < 0)
            .select(F.when(other, OTHER_CHAIN).otherwise("ton").alias("chain"), address("c_custkey").alias("address"),
                    F.when(other, OTHER_PROVIDER).otherwise("tonapi").alias("provider"),
                    F.lit("provider unavailable").alias("error")))


@query("failed_addresses")
def _(s: Sample) -> DataFrame:
    return ingest.failed_addresses(
        ingest.address_results(s.monitored(), s.chain_events(), _cycle_errors(s)))


@query("failed_address_lines")
def _(s: Sample) -> DataFrame:
    return ingest.failed_address_lines(
        ingest.address_results(s.monitored(), s.chain_events(), _cycle_errors(s)))


@query("stale_checkpoints")
def _(s: Sample) -> DataFrame:
    return lag.stale_checkpoints(s.checkpoints(), as_of())


@query("checkpoint_lookup")
def _(s: Sample) -> DataFrame:
    return checkpoints.checkpoint_lookup(s.checkpoints(), "ton", "0:000007", "tonapi")


# ---- joins ---------------------------------------------------------------------

@query("unprocessed_addresses")
def _(s: Sample) -> DataFrame:
    return diagnostics.unprocessed_addresses(s.monitored(), s.stored_events())


@query("unprocessed_wallets")
def _(s: Sample) -> DataFrame:
    return diagnostics.unprocessed_wallets(s.monitored(), s.stored_events())


@query("new_events")
def _(s: Sample) -> DataFrame:
    return (ingest.new_events(s.arrivals(), s.stored_events(CUT))
            .select("event_id", *WALLET, "lt", "tx_hash", "arrival_seq", "block_time"))


@query("fetch_after_checkpoint")
def _(s: Sample) -> DataFrame:
    return (ingest.fetch_after_checkpoint(s.chain_tx(), s.checkpoints(CUT))
            .select(*WALLET, "lt", "tx_hash", "block_time"))


@query("fetch_colocated")
def _(s: Sample) -> DataFrame:
    """The same from tables bucketed by wallet: neither side is shuffled."""
    root = shared_dir(s.spark, "bucketed")
    tx = colocated.write_bucketed(s.chain_tx().select(*WALLET, "lt", "tx_hash", "block_time"), f"{root}/tx", ["lt"], 8)
    marks = colocated.write_bucketed(s.checkpoints(CUT), f"{root}/marks", buckets=8)
    return colocated.fetch_colocated(tx, marks)


def _discovery(s: Sample) -> list[DataFrame]:
    """The parsed documents of both sources, each parsed once."""
    return [settle(holders.parse_native(s.native_docs()), "native"),
            settle(holders.parse_jetton(s.jetton_docs(), s.tokens()), "jetton")]


def _discoveries(s: Sample) -> DataFrame:
    """Discovered holders plus re-discovered order wallets (several arrivals per key)."""
    found = monitored.discovered(monitored.all_asset_holders(_discovery(s)), F.lit(0).cast("bigint"))
    again = s.table("orders").select(
        *asset_wallet("o_custkey", "o_orderpriority"), F.col("o_orderpriority").alias("asset_id"),
        F.concat(F.round(F.col("o_totalprice") * 100).cast("bigint"), F.lit("0000000")).alias("balance"),
        F.col("o_orderkey").alias("arrival_seq"))
    return found.unionByName(again)


@query("upsert_monitored")
def _(s: Sample) -> DataFrame:
    return monitored.upsert_monitored(s.monitored(), _discoveries(s), as_of())


@query("deactivate_addresses")
def _(s: Sample) -> DataFrame:
    """Wallets of customers in debt are deactivated; keys that are not monitored do nothing."""
    keys = (s.table("customer").where(F.col("c_acctbal") < 0)
            .select(F.lit(OTHER_CHAIN).alias("chain"), address("c_custkey").alias("address"),
                    F.lit(OTHER_PROVIDER).alias("provider"), F.lit(OTHER_ASSET).alias("asset_id")))
    return monitored.deactivate_addresses(s.monitored(), keys, as_of())


@query("ingest_active_only")
def _(s: Sample) -> DataFrame:
    return (ingest.ingest_active_only(s.chain_tx(), s.monitored())
            .select(*WALLET, "lt", "tx_hash", "block_time"))


@query("ingest_cycle")
def _(s: Sample) -> DataFrame:
    return (ingest.ingest_cycle(s.chain_tx(), s.monitored(), s.checkpoints(CUT))
            .select(*WALLET, "lt", "tx_hash", "block_time"))


# ---- aggregations ----------------------------------------------------------------

@query("addresses_per_asset")
def _(s: Sample) -> DataFrame:
    return diagnostics.addresses_per_asset(s.monitored())


@query("multi_asset_wallets")
def _(s: Sample) -> DataFrame:
    return diagnostics.multi_asset_wallets(s.monitored())


@query("events_summary")
def _(s: Sample) -> DataFrame:
    return diagnostics.events_summary(s.stored_events())


def _stored_days(s: Sample, counted: list[str]) -> DataFrame:
    """Daily sketches by chain, stored and read back."""
    return settle(sketches.daily(s.stored_events(), ["chain"], "created_at", counted), "sketches")


@query("events_summary_sketch")
def _(s: Sample) -> DataFrame:
    """The summary from stored daily sketches; estimates are held against the exact counts by their bound."""
    summed = sketches.merged(_stored_days(s, ["address", "event_id"]), [], ["address", "event_id"])
    exact = diagnostics.events_summary(s.stored_events())
    return exact.select(
        *(summed.select(c).scalar().alias(n) for c, n in (("rows", "total_events"), ("first_at", "first_event"), ("last_at", "last_event"))),
        sketches.within(summed.select("address_estimate").scalar(), F.col("addresses_with_events")).alias("addresses_within_bound"),
        sketches.within(summed.select("event_id_estimate").scalar(), F.col("unique_event_ids")).alias("event_ids_within_bound"))


@query("active_addresses_sketch")
def _(s: Sample) -> DataFrame:
    """Addresses per chain from the day of the cut on, by merging those days' sketches."""
    since = F.lit(CUT).cast("timestamp")
    summed = sketches.merged(_stored_days(s, ["address"]), ["chain"], ["address"], F.col("day") >= F.to_date(since))
    exact = (s.stored_events().where(F.col("created_at") >= since).groupBy("chain")
             .agg(F.count_distinct("address").alias("addresses")))
    return exact.join(summed, "chain").select(
        "chain", "addresses", "rows", sketches.within(F.col("address_estimate"), F.col("addresses")).alias("within_bound"))


@query("events_per_address_top10")
def _(s: Sample) -> DataFrame:
    return diagnostics.events_per_address(s.stored_events())


@query("checkpoint_progress")
def _(s: Sample) -> DataFrame:
    return diagnostics.checkpoint_progress(s.checkpoints())


@query("checkpoint_coverage")
def _(s: Sample) -> DataFrame:
    return diagnostics.checkpoint_coverage(s.monitored(), s.checkpoints())


@query("duplicate_event_ids")
def _(s: Sample) -> DataFrame:
    """Over the raw deliveries, where copies do exist."""
    return diagnostics.duplicate_event_ids(s.arrivals())


@query("system_summary")
def _(s: Sample) -> DataFrame:
    return diagnostics.system_summary(s.monitored(), s.stored_events(), s.checkpoints())


@query("discovery_freshness")
def _(s: Sample) -> DataFrame:
    return diagnostics.discovery_freshness(s.monitored())


@query("discovery_limit_check")
def _(s: Sample) -> DataFrame:
    return diagnostics.discovery_limit_check(s.monitored())


@query("checkpoint_timestamps")
def _(s: Sample) -> DataFrame:
    return lag.checkpoint_timestamps(s.checkpoints())


@query("active_wallet_count")
def _(s: Sample) -> DataFrame:
    return monitored.active_wallet_count(s.monitored())


@query("ingest_result")
def _(s: Sample) -> DataFrame:
    return ingest.ingest_result(ingest.address_results(s.monitored(), s.chain_events(), _cycle_errors(s)))


@query("address_results")
def _(s: Sample) -> DataFrame:
    return ingest.address_results(s.monitored(), s.chain_events(), _cycle_errors(s))


@query("events_ingested_total")
def _(s: Sample) -> DataFrame:
    return ingest.events_ingested_total(
        ingest.address_results(s.monitored(), s.chain_events(), _cycle_errors(s)))


@query("alerts_fired_total")
def _(s: Sample) -> DataFrame:
    return metrics.alerts_fired_total(alerts.whale_alerts(s.chain_events()))


@query("stale_wallets_by_chain")
def _(s: Sample) -> DataFrame:
    return lag.stale_wallets_by_chain(s.checkpoints(), as_of())


@query("dlq_depth")
def _(s: Sample) -> DataFrame:
    return retries.dlq_depth(retries.dead_letters(s.attempts()))


@query("discovery_stats")
def _(s: Sample) -> DataFrame:
    docs = _discovery(s)
    return monitored.discovery_stats(docs, monitored.all_asset_holders(docs))


@query("discovery_summary")
def _(s: Sample) -> DataFrame:
    docs = _discovery(s)
    return monitored.discovery_summary(monitored.discovery_stats(docs, monitored.all_asset_holders(docs)))


# ---- windows, sorts, sets ----------------------------------------------------------

@query("first_arrival")
def _(s: Sample) -> DataFrame:
    return (ingest.first_arrival(s.arrivals())
            .select("event_id", *WALLET, "lt", "tx_hash", "arrival_seq"))


@query("top_balances_per_asset")
def _(s: Sample) -> DataFrame:
    return diagnostics.top_balances_per_asset(s.monitored())


def _fold(s: Sample) -> DataFrame:
    narrow = s.arrivals().drop("raw_json", "correlation_id")
    return checkpoints.checkpoint_fold(settle(ingest.first_arrival(narrow), "first"))


@query("checkpoint_fold")
def _(s: Sample) -> DataFrame:
    return _fold(s).drop("arrived_at")


@query("checkpoint_conflicts")
def _(s: Sample) -> DataFrame:
    return checkpoints.checkpoint_conflicts(_fold(s)).drop("arrived_at")


@query("final_checkpoints")
def _(s: Sample) -> DataFrame:
    return checkpoints.final_checkpoints(s.arrivals(), s.checkpoints(CUT))


@query("limit_per_group")
def _(s: Sample) -> DataFrame:
    """The first transactions of every wallet, up to the fetch limit."""
    return (ingest.limit_per_group(s.chain_tx(), WALLET, [F.col("lt")], params.FETCH_LIMIT)
            .select(*WALLET, "lt", "tx_hash"))


@query("hold_for")
def _(s: Sample) -> DataFrame:
    """Lag samples of each wallet above the lag limit for at least a minute."""
    samples = s.samples().where(F.col("metric") == "event_lag_seconds")
    return rules.hold_for(samples, F.col("value") > params.LAG_ALERT_SECONDS, params.LAG_ALERT_HOLD_SECONDS)


@query("top_balances")
def _(s: Sample) -> DataFrame:
    return diagnostics.top_balances(s.monitored())


@query("top_balances_text")
def _(s: Sample) -> DataFrame:
    return diagnostics.top_balances(s.monitored(), mode="text")


@query("event_count")
def _(s: Sample) -> DataFrame:
    return diagnostics.event_count(s.stored_events())


@query("latest_checkpoints")
def _(s: Sample) -> DataFrame:
    return diagnostics.latest_checkpoints(s.checkpoints())


@query("all_asset_holders")
def _(s: Sample) -> DataFrame:
    return monitored.all_asset_holders(_discovery(s))


@query("distinct_addresses")
def _(s: Sample) -> DataFrame:
    return monitored.distinct_addresses(s.stored_events())


# ---- column jobs -----------------------------------------------------------------

@query("event_ids")
def _(s: Sample) -> DataFrame:
    return s.chain_tx().select("lt", fn.event_id("chain", "address", "lt", "tx_hash").alias("event_id"))


@query("event_ids_short")
def _(s: Sample) -> DataFrame:
    return s.chain_tx().select("lt", fn.event_id_short("chain", "lt", "tx_hash").alias("event_id"))


@query("cursor_text")
def _(s: Sample) -> DataFrame:
    return s.chain_tx().select("lt", fn.cursor_text("lt", "tx_hash").alias("cursor"))


@query("cursor_audit")
def _(s: Sample) -> DataFrame:
    """Cursor texts in good and broken forms, chosen by event type, with what the parser says."""
    kind, good = F.col("event_type"), fn.cursor_text("lt", "tx_hash")
    text = (F.when(kind == "purchase", good).when(kind == "click", F.col("lt").cast("string"))
            .when(kind == "view", F.concat(F.col("lt").cast("string"), F.lit(":")))
            .when(kind == "signup", F.concat(F.col("tx_hash"), F.lit("h:"), F.col("tx_hash")))
            .otherwise(F.concat(good, F.lit(":more"))))
    parsed = fn.parse_cursor(text)
    return (s.chain_tx().select("lt", text.alias("cursor"), parsed.alias("p"))
            .select("lt", "cursor", F.col("p").isNotNull().alias("accepted"),
                    F.col("p.primary").alias("primary_part"), F.col("p.secondary").alias("secondary_part")))


@query("sanitize_json")
def _(s: Sample) -> DataFrame:
    """Documents with both control characters mixed in, escaped and raw, then cleaned."""
    dirty = F.concat(F.lit("\\u0000"), F.col("raw_json"), F.chr(F.lit(0)), F.lit("\\u0001\\u0002"),
                     F.chr(F.lit(1)))
    return s.chain_events().select("event_id", fn.sanitize_json(dirty).alias("clean"))


@query("block_times")
def _(s: Sample) -> DataFrame:
    unix = F.floor(F.unix_micros("block_time") / 1_000_000)
    return s.chain_tx().select("lt", fn.block_time(unix).alias("block_time"))


@query("parse_balances")
def _(s: Sample) -> DataFrame:
    """Account balances as plain, padded, signed and non-integer texts."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    kind = F.col("c_mktsegment")
    text = (F.when(kind == "BUILDING", F.concat(cents, F.lit(".5")))
            .when(kind == "FURNITURE", F.concat(F.lit("  +000"), F.abs(cents), F.lit(" ")))
            .when(kind == "MACHINERY", F.concat(F.lit("1e"), F.abs(cents)))
            .when(kind == "HOUSEHOLD", F.concat(F.abs(cents), F.lit("0" * 33)))
            .otherwise(cents.cast("string")))
    return s.table("customer").select("c_custkey", fn.canonical_integer(text).alias("balance"))


@query("correlation_ids")
def _(s: Sample) -> DataFrame:
    """Header id before body id before a fresh one; of the random ids only the width shows."""
    kind = F.col("event_type")
    header = F.when(kind == "click", F.lit("header"))
    body = F.when(kind != "signup", F.col("correlation_id"))
    given = s.chain_events().select("event_id", F.coalesce(header, body).isNull().alias("fresh"),
                                    fn.correlation_id(header, body).alias("id"))
    return given.select("event_id", "fresh", F.when(~F.col("fresh"), F.col("id")).alias("given_id"),
                        F.length("id").alias("width"))


@query("to_units")
def _(s: Sample) -> DataFrame:
    return s.chain_tx().select("lt", fn.units(F.col("value_nano").cast("string")).alias("amount"))


@query("message_addresses")
def _(s: Sample) -> DataFrame:
    """Source and destination of every message of every document, lists of transactions included."""
    rows = alerts.message_list(s.chain_events().select("event_id", "raw_json"))
    return (rows.select("event_id", F.posexplode("messages").alias("position", "m"))
            .select("event_id", "position", alerts.message_address(F.col("m.source")).alias("source"),
                    alerts.message_address(F.col("m.destination")).alias("destination")))


@query("short_address")
def _(s: Sample) -> DataFrame:
    """Customer names (18 characters) and segments (8 to 10) in short form."""
    return s.table("customer").select(
        "c_custkey", fn.short_address(F.col("c_name")).alias("name"),
        fn.short_address(F.col("c_mktsegment")).alias("segment"))


@query("alert_text")
def _(s: Sample) -> DataFrame:
    return alerts.whale_alerts(s.chain_events()).select("event_id", "position", "direction", "message")


@query("lease_keys")
def _(s: Sample) -> DataFrame:
    parts = s.leases().select("lease_key", fn.lease_parts("lease_key").alias("p")).select("lease_key", "p.*")
    return parts.withColumn("rebuilt", fn.lease_key("chain", "provider", "address"))


@query("json_shape")
def _(s: Sample) -> DataFrame:
    """Evaluation status of each event's document, and of its damaged variants."""
    docs = s.chain_events().select("event_id", "lt", "tx_hash", F.posexplode(F.array(
        F.col("raw_json"), F.concat(F.col("raw_json"), F.lit(" tail")),
        F.concat(F.lit('{"transactions":['), F.col("raw_json"), F.lit(",null]}")),
        F.concat(F.lit('{"in_msg":null,"lt":'), F.col("lt"), F.lit("}")))).alias("variant_no", "raw_json"))
    return alerts.evaluate(docs).select("event_id", "variant_no", "status",
                                        F.coalesce(F.size("hits"), F.lit(0)).alias("alerts"))


# ---- alerts, handling, streams -------------------------------------------------------

@query("whale_alerts")
def _(s: Sample) -> DataFrame:
    return alerts.whale_alerts(s.chain_events())


def _shredded(s: Sample) -> DataFrame:
    events, path = s.chain_events(), shared_dir(s.spark, "shredded")
    stored_documents.store(events, path)
    return stored_documents.read_stored(s.spark, path, events.schema)


@query("stored_alerts")
def _(s: Sample) -> DataFrame:
    """The same from documents stored as shredded variants."""
    return stored_documents.stored_alerts(_shredded(s))


@query("stored_decisions")
def _(s: Sample) -> DataFrame:
    return alerts.decision_rows(stored_documents.evaluate_stored(_shredded(s)), as_of())


@query("page_alerts")
def _(s: Sample) -> DataFrame:
    """Every event of a page reports all large transfers of the page (the default scope)."""
    return alerts.page_alerts(s.tx_pages())


@query("page_alerts_own_tx")
def _(s: Sample) -> DataFrame:
    return alerts.page_alerts(s.tx_pages(), scope="own_tx")


@query("handle_batch")
def _(s: Sample) -> DataFrame:
    """All deliveries against the state stored earlier."""
    return handle.handle_batch(s.arrivals(), s.stored_events(CUT), s.checkpoints(CUT))


def _waves(s: Sample, rows: DataFrame, waves: Callable[[DataFrame], list[tuple[str, Column]]], root: str,
           run: Callable[[DataFrame, str], object]) -> None:
    """Rows as a stream that stops and goes on: each wave lands in its log's folder and is run before the next."""
    for log, wave in waves(rows):
        folder = f"{root}/landing/{log}"
        rows.where(wave).write.mode("append").parquet(folder)
        run(s.spark.readStream.schema(rows.schema).parquet(folder), log)


def _delivery_waves(arrivals: DataFrame) -> list[tuple[str, Column]]:
    """Three waves in the order of arrival; a new log takes the last one, over the same tables."""
    seq = F.col("arrival_seq")
    middle = arrivals.agg(F.floor(F.avg(F.when(seq < REDELIVERED, seq))).cast("bigint")).first()[0]
    return [("old", (seq < middle) & (seq < REDELIVERED)), ("old", (seq >= middle) & (seq < REDELIVERED)), ("new", seq >= REDELIVERED)]


def _stream_waves(s: Sample, root: str, each: Callable[[DataFrame, int], object],
                  prepared: Callable[[DataFrame], DataFrame] = lambda stream: stream) -> None:
    """All deliveries in waves, batch by batch."""
    _waves(s, s.arrivals(), _delivery_waves, root, lambda stream, log: runs.run_available(
        prepared(stream), each, f"{root}/log-{log}"))


@query("handle_stream")
def _(s: Sample) -> DataFrame:
    """The consumer as a stream over all deliveries; its per-event results read back."""
    root = shared_dir(s.spark, "handled")
    _stream_waves(s, root, runs.handle(root, created_at=F.col("block_time")))
    return runs.read_output(s.spark, root, "results").drop("run", "batch")


@query("handle_stream_compacted")
def _(s: Sample) -> DataFrame:
    """The consumer as a stream that compacts its tables as it goes."""
    root = shared_dir(s.spark, "compacted")
    _stream_waves(s, root, runs.compacting(root, runs.handle(root, created_at=F.col("block_time")), most=1))
    return runs.read_output(s.spark, root, "results").drop("run", "batch")


@query("handler_metrics")
def _(s: Sample) -> DataFrame:
    """Counters that the streaming handler observes while it writes, summed over its batches."""
    root = shared_dir(s.spark, "observed")
    _stream_waves(s, root, runs.handle(root, created_at=F.col("block_time"), decided_at=as_of()))
    return (runs.read_metrics(s.spark, root).groupBy("metric").agg(F.sum("value").cast("bigint").alias("value")))


@query("dedupe_stream")
def _(s: Sample) -> DataFrame:
    root = shared_dir(s.spark, "deduped")
    _stream_waves(s, root, runs.store_new(root, created_at=F.col("block_time")))
    return (table_sink.read_events(s.spark, root)
            .select("event_id", *WALLET, "lt", "tx_hash", "arrival_seq"))


@query("dedupe_stream_bounded")
def _(s: Sample) -> DataFrame:
    root = shared_dir(s.spark, "bounded")
    _stream_waves(s, root, runs.store_within(root, created_at=F.col("block_time")))
    return table_sink.read_events(s.spark, root).select("event_id", *WALLET, "lt", "tx_hash")


@query("dedupe_stream_watermark")
def _(s: Sample) -> DataFrame:
    """The same with Spark's watermark state; what it drops as late or copied is looked up exactly."""
    root = shared_dir(s.spark, "watermarked")
    _stream_waves(s, root, runs.store_passed(root, created_at=F.col("block_time")), runs.within_watermark)
    return (table_sink.read_events(s.spark, root)
            .select("event_id", *WALLET, "lt", "tx_hash", "arrival_seq"))


@query("checkpoint_stream")
def _(s: Sample) -> DataFrame:
    root = shared_dir(s.spark, "marks")
    _stream_waves(s, root, runs.track(root))
    return table_sink.read_checkpoints(s.spark, root)


@query("checkpoint_stream_conflicts")
def _(s: Sample) -> DataFrame:
    root = shared_dir(s.spark, "conflicts")
    _stream_waves(s, root, runs.track(root))
    return runs.read_output(s.spark, root, "conflicts").drop("run", "batch", "arrived_at")


def _keyed_outcomes(s: Sample) -> DataFrame:
    """Outcomes of all deliveries by keyed state: two waves through one log, the third through a new one."""
    root = shared_dir(s.spark, "keyed")

    def prepared(stream: DataFrame, log: str) -> DataFrame:
        return keyed.outcomes(stream, s.spark.read.schema(keyed.OUTCOME).parquet(f"{root}/old") if log == "new" else None)

    _waves(s, s.arrivals(), _delivery_waves, root, lambda stream, log: runs.append_available(
        prepared(stream, log), f"{root}/{log}", f"{root}/log-{log}"))
    return s.spark.read.schema(keyed.OUTCOME).parquet(f"{root}/old", f"{root}/new")


@query("checkpoint_stream_keyed")
def _(s: Sample) -> DataFrame:
    return keyed.checkpoints(_keyed_outcomes(s))


@query("checkpoint_stream_keyed_conflicts")
def _(s: Sample) -> DataFrame:
    return _keyed_outcomes(s).where(F.col("outcome") == "conflict").drop("arrived_at")


def _event_waves(events: DataFrame) -> list[tuple[str, Column]]:
    """Three waves through one log, by chain and number."""
    middle = events.agg(F.floor(F.avg("lt")).cast("bigint")).first()[0]
    second = F.col("chain") == OTHER_CHAIN
    return [("one", ~second & (F.col("lt") < middle)), ("one", second), ("one", ~second & (F.col("lt") >= middle))]


@query("events_ingested_stream")
def _(s: Sample) -> DataFrame:
    """Events per chain, counted by a stream in three waves."""
    root = shared_dir(s.spark, "ingested")
    _waves(s, s.chain_tx(), _event_waves, root, lambda stream, log: counters.run_updates(
        counters.totals(stream, ["chain"]), counters.upsert(root, "ingested", ["chain"]), f"{root}/log"))
    return counters.read_totals(s.spark, root, "ingested", ["chain"])


@query("alerts_fired_stream")
def _(s: Sample) -> DataFrame:
    """Alerts per asset and direction, counted by a stream in three waves."""
    root, keys = shared_dir(s.spark, "fired"), ["asset_id", "direction"]
    _waves(s, s.chain_events(), _event_waves, root, lambda stream, log: counters.run_updates(
        counters.totals(alerts.whale_alerts(stream), keys), counters.upsert(root, "fired", keys), f"{root}/log"))
    return counters.read_totals(s.spark, root, "fired", keys).withColumnRenamed("total", "alerts")


@query("ingest_rate_stream")
def _(s: Sample) -> DataFrame:
    """The ingest rate of closed windows, from minutes that a stream has counted in three waves."""
    root = shared_dir(s.spark, "rates")
    _waves(s, s.chain_tx(), _event_waves, root, lambda stream, log: runs.run_available(
        counters.minutes(stream, "block_time", "chain"), counters.keep_minutes(root), f"{root}/log"))
    return counters.read_rate(s.spark, root)


@query("failed_events")
def _(s: Sample) -> DataFrame:
    """Events whose document is JSON of the wrong shape, made from all events."""
    wrong = F.concat(F.lit('{"in_msg":null,"lt":'), F.col("lt"), F.lit("}"))
    docs = s.chain_events().withColumn("raw_json", F.when(F.col("lt") % 3 == 0, wrong).otherwise(F.col("raw_json")))
    return alerts.failed_events(docs).select("event_id", *WALLET, "status")


@query("dead_letters")
def _(s: Sample) -> DataFrame:
    return retries.dead_letters(s.attempts())


# ---- monitoring --------------------------------------------------------------------

@query("event_lag")
def _(s: Sample) -> DataFrame:
    return lag.event_lag(s.checkpoints(), as_of())


@query("ingest_rate_5m")
def _(s: Sample) -> DataFrame:
    return rates.rate(s.chain_tx(), F.col("block_time"), "chain")


@query("ingest_rate_counter_5m")
def _(s: Sample) -> DataFrame:
    """The same rate from counter samples that start again every day."""
    return rates.counter_rate(settle(s.counter_samples(), "counter"))


@query("alert_rate_5m")
def _(s: Sample) -> DataFrame:
    """Alert rates by direction and in total, timed by the block time of the event."""
    timed = alerts.whale_alerts(s.chain_events(), extra=("block_time",))
    return rates.rate(timed, F.col("block_time"), "direction")


@query("max_lag")
def _(s: Sample) -> DataFrame:
    return lag.max_lag(s.checkpoints(), as_of())


@query("max_lag_series")
def _(s: Sample) -> DataFrame:
    return gauges.gauge_max_series(s.samples(), "event_lag_seconds")


@query("gauge_sums")
def _(s: Sample) -> DataFrame:
    return gauges.gauge_sums(s.samples())


@query("discovery_age")
def _(s: Sample) -> DataFrame:
    return gauges.discovery_age(s.samples(), as_of())


@query("health_bands")
def _(s: Sample) -> DataFrame:
    """Current values of the dashboard tiles with their bands."""
    samples = s.samples()
    sums = gauges.gauge_sums(samples).where(
        F.col("metric").isin("dlq_messages", "circuit_breaker_state", "event_lag_stale_wallets"))
    worst = lag.max_lag(s.checkpoints(), as_of()).select(
        F.lit("event_lag_seconds").alias("metric"), F.col("max_lag_seconds").alias("value"))
    age = gauges.discovery_age(samples, as_of()).select(
        F.lit("discovery_age_seconds").alias("metric"), F.col("age_seconds").alias("value"))
    return gauges.health_bands(sums.unionByName(worst).unionByName(age))


@query("rule_dlq")
def _(s: Sample) -> DataFrame:
    return rules.sampled_rules(s.samples(), [rules.DLQ])


@query("rule_breaker_open")
def _(s: Sample) -> DataFrame:
    return rules.sampled_rules(s.samples(), [rules.BREAKER_OPEN])


@query("rule_ingestion_stalled_stream")
def _(s: Sample) -> DataFrame:
    """The same rule by timers in a stream of three waves; a clock row ends the last one."""
    root = shared_dir(s.spark, "stalls")
    tick = F.to_timestamp(F.lit(AS_OF)) + F.expr("INTERVAL 10 MINUTES")
    clock = s.spark.range(1).select(F.lit(None).cast("string").alias("chain"), F.lit(None).cast("bigint").alias("lt"), tick.alias("block_time"))
    rows = s.chain_tx().select("chain", "lt", "block_time").unionByName(clock)

    def waves(given: DataFrame) -> list[tuple[str, Column]]:
        edges = percentiles(given, "lt", (0.3, 0.8))
        return [("one", F.col("lt") <= edges[0]), ("one", (F.col("lt") > edges[0]) & (F.col("lt") <= edges[1])),
                ("one", F.col("lt").isNull() | (F.col("lt") > edges[1]))]

    _waves(s, rows, waves, root, lambda stream, log: runs.append_available(
        stalls.stalls(stream, "chain", "block_time"), f"{root}/changes", f"{root}/log"))
    return stalls.firing(s.spark.read.schema(stalls.CHANGE).parquet(f"{root}/changes"), as_of())


@query("rule_ingestion_stalled")
def _(s: Sample) -> DataFrame:
    return rules.rule_ingestion_stalled(s.chain_tx(), as_of())


def _advances(s: Sample) -> DataFrame:
    return _fold(s).where(F.col("outcome") == "advance")


@query("rule_lag_high")
def _(s: Sample) -> DataFrame:
    return rules.rule_lag_high(_advances(s), as_of())


@query("rule_discovery_failed")
def _(s: Sample) -> DataFrame:
    return rules.sampled_rules(s.samples(), [rules.DISCOVERY_FAILED])


@query("notification_schedule")
def _(s: Sample) -> DataFrame:
    """Send times over the firing intervals of all five rules."""
    firing = [rules.sampled_rules(s.samples()), rules.rule_ingestion_stalled(s.chain_tx(), as_of()),
              rules.rule_lag_high(_advances(s), as_of())]
    return rules.notification_schedule(reduce(DataFrame.unionByName, firing))
