"""Chain-shaped views over the given tables (events, orders, customer, supplier).

The given tables hold no blockchain data, so wallets, transactions, pages, holder
lists, deliveries and metric samples are derived from them with plain column
expressions. Every view covers its whole source table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from walletscope.functions import event_id
from walletscope.operators.gauges import series_key
from walletscope.plans.running import running_sum
from walletscope.schemas import WALLET
from walletscope.session import prepare
from walletscope.sources.messages import failed_attempts

AS_OF = "2024-01-31 00:00:00"
CUT = "2024-01-15 00:00:00"  # state "as stored earlier" for fetch and dedupe queries
PAGE_ROWS = 20
REDELIVERED = 10_000_002  # arrival number from which on copies come
OTHER_CHAIN, OTHER_PROVIDER = "ever", "everapi"
OTHER_ASSET = "5-LOW"  # the asset held on the second chain

# Configured tokens: master address and symbol. Lists of other masters are not asked for.
TOKENS = [("0:automobile", "AUTO"), ("0:building", "BLDG"),
          ("0:furniture", "FURN"), ("0:household", "HOUS")]


def as_of() -> Column:
    return F.to_timestamp(F.lit(AS_OF))


def address(key) -> Column:
    """Wallet address of a numeric key: at least six digits, longer keys in full."""
    digits = F.col(key).cast("string")
    return F.concat(F.lit("0:"), F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), F.lit("0")))


def asset_wallet(key: str, asset: str) -> list[Column]:
    """Wallet columns of a holder of an asset; one asset lives on the second chain."""
    second = F.col(asset) == OTHER_ASSET
    return [F.when(second, OTHER_CHAIN).otherwise("ton").alias("chain"), address(key).alias("address"),
            F.when(second, OTHER_PROVIDER).otherwise("tonapi").alias("provider")]


def cents(amount) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def tx_hash(lt: Column) -> Column:
    return F.substring(F.sha2(lt.cast("string"), 256), 1, 16)


def _zero_filled(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _raw_json() -> Column:
    nano = F.col("value_nano")
    half = F.expr("value_nano div 2")
    tag = F.col("lt") % 97
    purchase = F.concat(
        F.lit('{"in_msg":{"source":"0:SRC'), _zero_filled(tag, 8), F.lit('","destination":"'),
        F.col("address"), F.lit('","value":"'), nano, F.lit('"}}'))
    click = F.concat(
        F.lit('{"out_msgs":[{"destination":{"workchain_id":0,"address":"EQ'), _zero_filled(tag, 10),
        F.lit('"},"value":'), nano, F.lit('},{"value":"'), half, F.lit('"}]}'))
    view = F.concat(F.lit('{"transactions":[{"in_msg":{"value":"'), nano,
                    F.lit('"}},{"out_msgs":[{"value":"'), nano, F.lit('"}]}]}'))
    kind = F.col("event_type")
    return (F.when(kind == "purchase", purchase).when(kind == "click", click)
            .when(kind == "view", view).when(kind == "signup", F.lit('{"test": true}'))
            .otherwise(F.lit("{ invalid json }")))


def tx_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """Rows of ``events`` as transactions; works on batch and streaming input.

    A fifth of them is of a second chain with a provider of its own, under the same
    addresses, so a key that leaves out the chain or the provider shows. ``extra`` names
    further columns to keep.
    """
    lt = F.col("event_id")
    second = lt % 5 == 0
    return events.select(
        lt.alias("lt"), F.when(second, OTHER_CHAIN).otherwise("ton").alias("chain"),
        F.when(second, OTHER_PROVIDER).otherwise("tonapi").alias("provider"),
        address("user_id").alias("address"), tx_hash(lt).alias("tx_hash"),
        F.col("ts").cast("timestamp").alias("block_time"), "event_type",
        (cents("value") * 10_000_000).alias("value_nano"), "value", *extra)


def events_from_tx(tx: DataFrame) -> DataFrame:
    """Transactions as event messages with ids, documents and body correlation ids."""
    return (tx.withColumn("event_id", event_id("chain", "address", "lt", "tx_hash"))
            .withColumn("raw_json", _raw_json())
            .withColumn("correlation_id", F.substring(F.sha2("event_id", 256), 1, 32)))


def arrivals_from_events(events: DataFrame) -> DataFrame:
    """Deliveries of every row of ``events``: the original, redeliveries, and same-lt rivals with another hash.

    The deliveries come first and all else is made of them, so that a choice by ``arrival_seq``
    is made on the given columns: documents and digests are only made for the rows chosen.
    """
    lt = F.col("event_id")

    def delivery(seq: Column, rival: bool) -> Column:
        return F.array(F.struct(seq.cast("bigint").alias("seq"), F.lit(rival).alias("rival")))

    none = F.array().cast("array<struct<seq: bigint, rival: boolean>>")
    deliveries = F.concat(delivery(lt * 4, False), F.when(lt % 97 == 0, delivery(lt * 4 + 1, True)).otherwise(none),
                          F.when(lt % 10 == 0, delivery(lt * 4 + REDELIVERED, False)).otherwise(none))
    delivered = events.withColumn("_d", F.explode(deliveries))
    made = events_from_tx(tx_from_events(delivered, "_d")).drop("event_id", "correlation_id")
    return (made.withColumn("tx_hash", F.when(F.col("_d.rival"), F.concat(F.lit("x"), F.col("tx_hash"))).otherwise(F.col("tx_hash")))
            .select(event_id("chain", "address", "lt", "tx_hash").alias("event_id"),
                    "chain", "provider", "address", "lt", "tx_hash",
                    "block_time", "raw_json", F.col("_d.seq").alias("arrival_seq"),
                    F.col("block_time").alias("arrived_at"))
            .withColumn("correlation_id", F.substring(F.sha2("event_id", 256), 1, 32)))


@dataclass(frozen=True)
class Sample:
    """The derived views of one data folder."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        prepare(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The same table as a file stream (one file or a folder of files)."""
        return (self.spark.readStream.schema(self.table(name).schema)
                .parquet(f"{self.root}/{name}.parquet*"))

    def chain_tx(self) -> DataFrame:
        return tx_from_events(self.table("events"))

    def chain_events(self) -> DataFrame:
        return events_from_tx(self.chain_tx())

    def stored_events(self, before: str | None = None) -> DataFrame:
        """Stored rows: ``created_at`` is the block time."""
        rows = self.chain_events().withColumn("created_at", F.col("block_time"))
        return rows if before is None else rows.where(F.col("block_time") < F.lit(before).cast("timestamp"))

    def arrivals(self) -> DataFrame:
        return arrivals_from_events(self.table("events"))

    def monitored(self) -> DataFrame:
        return (self.table("orders").groupBy("o_custkey", "o_orderpriority")
                .agg(F.sum(cents("o_totalprice")).alias("total"),
                     F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
                .select(*asset_wallet("o_custkey", "o_orderpriority"), F.col("o_orderpriority").alias("asset_id"),
                        F.concat(F.col("total").cast("string"), F.lit("0000000")).alias("balance"),
                        (F.col("o_custkey") % 10 != 0).alias("is_active"),
                        F.col("first").cast("timestamp").alias("discovered_at"),
                        F.col("last").cast("timestamp").alias("updated_at")))

    def checkpoints(self, before: str | None = None) -> DataFrame:
        tx = self.chain_tx()
        if before is not None:
            tx = tx.where(F.col("block_time") < F.lit(before).cast("timestamp"))
        return (tx.groupBy(*WALLET)
                .agg(F.max("lt").alias("last_lt"), F.max("block_time").alias("updated_at"))
                .select(*WALLET, "last_lt", tx_hash(F.col("last_lt")).alias("last_hash"), "updated_at"))

    def leases(self) -> DataFrame:
        ends = F.timestamp_micros(F.unix_micros(as_of()) + cents("s_acctbal") * 10_000)
        return self.table("supplier").select(
            F.concat(F.lit("ton:tonapi:"), address("s_suppkey")).alias("lease_key"),
            F.lit("ingestor").alias("owner_id"), ends.alias("expires_at"))

    def tx_pages(self) -> DataFrame:
        """Landing-zone documents: 20 transactions of a wallet per page, in lt order."""
        numbered = running_sum(self.chain_tx().drop("event_type", "value"), WALLET, ["lt"],
                               F.shiftright("lt", 20), F.lit(1), "_before")
        tx = F.struct("lt", F.col("tx_hash").alias("hash"),
                      F.floor(F.unix_micros("block_time") / 1_000_000).alias("utime"),
                      F.struct(F.col("value_nano").cast("string").alias("value")).alias("in_msg"))
        return (numbered.groupBy(*WALLET, F.floor(F.col("_before") / PAGE_ROWS).alias("page_no"))
                .agg(F.sort_array(F.collect_list(tx)).alias("transactions"))
                .select(*WALLET, "page_no", F.to_json(F.struct("transactions")).alias("body")))

    def native_docs(self) -> DataFrame:
        """Native holder lists, 100 accounts per document; some balances are not plain integers."""
        text = (F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal").cast("string"))
                .when(F.col("c_mktsegment") == "FURNITURE",
                      F.concat(F.lit(" +00"), F.abs(cents("c_acctbal")), F.lit("0000000 ")))
                .otherwise(F.concat(cents("c_acctbal"), F.lit("0000000"))))
        entry = F.struct(address("c_custkey").alias("account"), text.alias("balance"))
        return (self.table("customer").groupBy(F.floor(F.col("c_custkey") / 100).alias("doc_no"))
                .agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("body")))

    def jetton_docs(self) -> DataFrame:
        """Token holder lists by segment; the lists of one token are cut off."""
        wide = F.concat(F.abs(cents("c_acctbal")), F.lit("0" * 27))
        entry = F.struct(address("c_custkey").alias("owner"),
                         F.when(F.col("c_nationkey") == 0, F.lit("0")).otherwise(wide).alias("balance"))
        master = F.concat(F.lit("0:"), F.lower("c_mktsegment"))
        whole = F.to_json(F.struct(F.col("entries").alias("jetton_wallets")))
        cut = F.expr("left(whole, length(whole) - 3)")
        return (self.table("customer")
                .groupBy(master.alias("master_address"), F.floor(F.col("c_custkey") / 100).alias("doc_no"))
                .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
                .withColumn("whole", whole)
                .select("master_address", "doc_no",
                        F.when(F.col("master_address") == "0:household", cut)
                        .otherwise(F.col("whole")).alias("body")))

    def tokens(self) -> DataFrame:
        return self.spark.createDataFrame(TOKENS, "master_address string, symbol string")

    def message_bodies(self, events: DataFrame | None = None) -> DataFrame:
        """A message body per event, some damaged: ``null``, cut off, without a field, with a tail, in a list."""
        events = self.chain_events() if events is None else events
        fields = {"correlation_id": F.col("correlation_id"), "event_id": F.col("event_id"), "chain": F.col("chain"),
                  "provider": F.col("provider"), "address": F.col("address"),
                  "cursor": F.struct(F.col("lt").alias("primary"), F.col("tx_hash").alias("secondary")),
                  "occurred_at": F.col("block_time"), "raw_json": F.col("raw_json")}

        def text(leave_out: str = "") -> Column:
            kept = F.struct(*(c.alias(n) for n, c in fields.items() if n != leave_out))
            return F.to_json(kept, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})

        damage = self.damage()
        value = (F.when(damage == "null", F.lit("null"))
                 .when(damage == "cut", F.expr("left(_text, length(_text) - 2)"))
                 .when(damage == "missing", text("cursor")).when(damage == "tail", F.concat("_text", F.lit(" tail")))
                 .when(damage == "listed", F.concat(F.lit("["), "_text", F.lit("]"))).otherwise(F.col("_text")))
        return events.withColumn("_text", text()).withColumn("value", value).drop("_text")

    @staticmethod
    def damage() -> Column:
        """What is wrong with the body of an event, NULL for most."""
        kind, lt = F.col("event_type"), F.col("lt")
        return (F.when(kind == "signup", "null").when(kind == "error", "cut")
                .when((kind == "purchase") & (lt % 11 == 0), "missing").when((kind == "click") & (lt % 13 == 0), "tail")
                .when((kind == "view") & (lt % 17 == 0), "listed"))

    def attempts(self) -> DataFrame:
        """Failed deliveries of all event types: what the decoder rejects, delivered one to four times."""
        tries = F.when(F.col("event_type") == "signup", F.lit(1)).otherwise(F.col("lt") % 4 + 1)
        deliveries = self.message_bodies().select(
            F.concat(F.lit("events."), F.col("event_type")).alias("queue"), F.col("event_id").alias("message_id"),
            "value", F.explode(F.sequence(F.lit(1).cast("bigint"), tries.cast("bigint"))).alias("attempt"))
        return failed_attempts(deliveries)

    def samples(self) -> DataFrame:
        """Metric samples: one per event, the metric chosen by its type."""
        kind, value = F.col("event_type"), F.col("value")
        whole = F.floor(value)
        unix = F.floor(F.unix_micros("block_time") / 1_000_000)
        metric = (F.when(kind == "error", "dlq_messages").when(kind == "click", "circuit_breaker_state")
                  .when(kind == "signup", "discovery_last_success_timestamp_seconds")
                  .when(kind == "view", "event_lag_seconds").otherwise("event_lag_stale_wallets"))
        number = (F.when(kind == "error", whole % 4).when(kind == "click", whole % 3)
                  .when(kind == "signup", unix - F.floor(value * 100))
                  .when(kind == "view", F.floor(value * 30)).otherwise(whole % 7))
        none = F.create_map().cast("map<string,string>")
        labels = (F.when(kind == "error", F.create_map(F.lit("queue"), F.lit("events.dead")))
                  .when(kind == "view", F.create_map(F.lit("chain"), F.col("chain"),
                                                     F.lit("address"), F.col("address")))
                  .when(kind == "purchase", F.create_map(F.lit("chain"), F.col("chain")))
                  .otherwise(none))
        return (self.chain_tx().select(metric.alias("metric"), labels.alias("labels"),
                                       F.col("block_time").alias("ts"), number.cast("double").alias("value"),
                                       F.col("lt").alias("sample_id"))
                .withColumn("series", series_key(F.col("labels"))))

    def counter_samples(self) -> DataFrame:
        """The ingest counter per chain, sampled at full minutes, starting again every day.

        The window runs over the minutes of one day, 1440 rows at most.
        """
        day = Window.partitionBy("chain", F.date_trunc("day", "ts")).orderBy("ts")
        return (self.chain_tx().groupBy("chain", F.date_trunc("minute", "block_time").alias("ts"))
                .agg(F.count("*").alias("n"))
                .select(F.concat(F.lit("chain="), F.col("chain")).alias("series"), "ts",
                        F.sum("n").over(day).cast("double").alias("value")))
