"""From transactions to deterministic events: normalise, dedupe, fetch windows, cycle results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from walletscope import params
from walletscope.functions import block_time, event_id
from walletscope.plans.spread_join import spread_join
from walletscope.schemas import WALLET


def normalize_events(transactions: DataFrame) -> DataFrame:
    """Page transactions (with their cleaned page body) to event messages with deterministic ids."""
    return transactions.select(
        event_id("chain", "address", "lt", "tx_hash").alias("event_id"),
        "chain", "provider", "address",
        F.struct(F.col("lt").alias("primary"), F.col("tx_hash").alias("secondary")).alias("cursor"),
        block_time("utime").alias("occurred_at"),
        F.col("body").alias("raw_json"))


def events_to_rows(messages: DataFrame) -> DataFrame:
    """Messages to the stored row shape (the provider is kept for state keyed by it)."""
    return messages.select(
        "event_id", "chain", "address", F.col("cursor.primary").alias("lt"),
        F.col("cursor.secondary").alias("tx_hash"), F.col("occurred_at").alias("block_time"),
        "raw_json")


def limit_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int,
                    rank_as: str | None = None) -> DataFrame:
    """At most ``n`` rows per key in the given order, with their rank if it has a name.

    The rank filter becomes a group limit before the shuffle, so a hot key sends
    at most ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    top = df.withColumn("_rank", rank).where(F.col("_rank") <= n)
    return top.withColumnRenamed("_rank", rank_as) if rank_as else top.drop("_rank")


def first_arrival(arrivals: DataFrame) -> DataFrame:
    """The first arrival of every event id wins, whatever later copies carry.

    Arrivals without an id are copies of nothing; see ``unidentified``.
    """
    known = arrivals.where(F.col("event_id").isNotNull())
    return limit_per_group(known, ["event_id"], [F.col("arrival_seq")], 1)


def unidentified(arrivals: DataFrame) -> DataFrame:
    """Arrivals without an event id, kept for repair."""
    return arrivals.where(F.col("event_id").isNull())


def new_events(arrivals: DataFrame, stored: DataFrame) -> DataFrame:
    """First arrivals whose id is not stored yet."""
    return first_arrival(arrivals).join(stored.select("event_id"), "event_id", "left_anti")


def after_cursor(transactions: DataFrame, checkpoints: DataFrame, **skew) -> DataFrame:
    """Transactions later than their wallet's checkpoint; all where there is none."""
    state = checkpoints.select(*WALLET, "last_lt")
    joined = spread_join(transactions, state, WALLET, "left", "lt", **skew)
    return joined.where(F.col("last_lt").isNull() | (F.col("lt") > F.col("last_lt"))).drop("last_lt")


def fetch_after_checkpoint(transactions: DataFrame, checkpoints: DataFrame,
                           limit: int = params.FETCH_LIMIT, **skew) -> DataFrame:
    """The next ``limit`` transactions of each wallet, lowest lt first so no gap can form."""
    return limit_per_group(after_cursor(transactions, checkpoints, **skew), WALLET,
                           [F.col("lt"), F.col("tx_hash")], limit)


def active_wallets(monitored: DataFrame) -> DataFrame:
    return monitored.where("is_active").select(*WALLET).distinct()


def ingest_active_only(transactions: DataFrame, monitored: DataFrame, **skew) -> DataFrame:
    """Transactions of active monitored wallets; none active gives an empty result."""
    return spread_join(transactions, active_wallets(monitored), WALLET, "left_semi", "lt", **skew)


def ingest_cycle(transactions: DataFrame, monitored: DataFrame, checkpoints: DataFrame,
                 limit: int = params.FETCH_LIMIT, **skew) -> DataFrame:
    """One cycle's transactions: the next ones of every active wallet after its checkpoint.

    Activity and checkpoint are first brought together per wallet, so the large
    side is joined once.
    """
    state = active_wallets(monitored).join(checkpoints.select(*WALLET, "last_lt"), WALLET, "left")
    joined = spread_join(transactions, state, WALLET, "inner", "lt", **skew)
    later = joined.where(F.col("last_lt").isNull() | (F.col("lt") > F.col("last_lt"))).drop("last_lt")
    return limit_per_group(later, WALLET, [F.col("lt"), F.col("tx_hash")], limit)


def address_results(monitored: DataFrame, published: DataFrame, errors: DataFrame,
                    chain: str = params.CHAIN, provider: str = params.PROVIDER) -> DataFrame:
    """Per active address of a chain and provider: events published and error text.

    ``published`` and ``errors(chain, address, provider, error)`` may hold other chains
    and providers, which do not count. Failing addresses are processed with no events,
    and the others are not affected.
    """
    here = (F.col("chain") == chain) & (F.col("provider") == provider)
    addresses = monitored.where(here & F.col("is_active")).select("address").distinct()
    counted = published.where(here).groupBy("address").agg(F.count("*").alias("n"))
    failures = errors.where(here).groupBy("address").agg(F.min("error").alias("error"))
    return (addresses.join(counted, "address", "left").join(failures, "address", "left")
            .select("address", F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0)))
                    .otherwise(0).alias("events_published"), "error"))


def ingest_result(results: DataFrame) -> DataFrame:
    """Roll-up of one cycle."""
    return results.agg(
        F.count("*").alias("addresses_processed"),
        F.coalesce(F.sum("events_published"), F.lit(0)).alias("total_events_published"),
        F.count("error").alias("addresses_failed"))


def failed_addresses(results: DataFrame) -> DataFrame:
    """Addresses whose cycle failed, one row each."""
    return results.where(F.col("error").isNotNull()).select("address", "error")


def failed_address_lines(results: DataFrame, per_line: int = 100) -> DataFrame:
    """The failed addresses joined into log lines of about ``per_line`` addresses.

    One line for all would grow without bound; addresses are spread by hash over
    as many lines as their number asks for.
    """
    listed = failed_addresses(results)
    lines = listed.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / per_line))).scalar()
    number = F.conv(F.substring(F.sha2("address", 256), 1, 8), 16, 10).cast("bigint") % lines
    joined = F.expr("listagg(address, ', ') WITHIN GROUP (ORDER BY address)")
    return (listed.groupBy(number.alias("line_no"))
            .agg(F.count("*").alias("failed"), joined.alias("addresses")))


def events_ingested_total(results: DataFrame, chain: str = params.CHAIN) -> DataFrame:
    """Counter increment of a cycle; a cycle without events adds nothing."""
    return (results.agg(F.sum("events_published").alias("events"))
            .where(F.col("events") > 0).select(F.lit(chain).alias("chain"), "events"))
