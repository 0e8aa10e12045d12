"""The monitored set: holder discovery, keyed upsert, deactivation, active reads."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from walletscope import params
from walletscope.operators.ingest import limit_per_group
from walletscope.schemas import MONITORED_KEY
from walletscope.sources.holders import holder_rows


def by_value() -> list[Column]:
    """Largest first for integer texts of any width and sign, ties by address."""
    negative = F.startswith("balance", F.lit("-"))
    width = F.length("balance")
    number = F.col("balance").try_cast("decimal(38,0)")
    return [F.when(negative, -width).otherwise(width).desc(), number.desc_nulls_last(),
            F.when(negative, F.col("balance")).asc_nulls_last(), F.col("balance").desc(),
            F.col("address")]


def all_asset_holders(parsed: list[DataFrame], limit: int = params.TOP_HOLDERS_LIMIT) -> DataFrame:
    """Top holders of every asset source; an asset with an unreadable document is skipped whole.

    ``rank`` keeps the order of an asset's holders. The limit comes first: it cuts each
    asset before its rows are shuffled, and the failed assets then leave out few rows.
    The documents are read twice, so hand in settled ones.
    """
    docs = reduce(DataFrame.unionByName, parsed)
    failed = docs.where(~F.col("readable")).select("asset_id").distinct()
    top = limit_per_group(holder_rows(docs), ["asset_id"], by_value(), limit, rank_as="rank")
    return top.join(failed, "asset_id", "left_anti")


def discovery_stats(parsed: list[DataFrame], holders: DataFrame) -> DataFrame:
    """Per asset: whether its source succeeded and how many holder rows it gave."""
    docs = reduce(DataFrame.unionByName, parsed)
    status = docs.groupBy("asset_id", "asset_type").agg(F.bool_and("readable").alias("ok"))
    counted = holders.groupBy("asset_id").agg(F.count("*").alias("n"))
    return (status.join(counted, "asset_id", "left")
            .select("asset_id", "asset_type", "ok", F.coalesce("n", F.lit(0)).alias("holders")))


def discovery_summary(stats: DataFrame) -> DataFrame:
    """Cycle totals; the cycle fails if sources failed and none succeeded."""
    totals = stats.agg(F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
                       F.coalesce(F.sum("holders"), F.lit(0)).alias("total_holders"))
    dead = (F.col("succeeded") == 0) & (F.col("failed") > 0)
    checked = F.when(dead, F.raise_error(F.lit("all asset sources failed")).cast("bigint")
                     ).otherwise(F.col("succeeded"))
    return totals.select(checked.alias("succeeded"), "failed", "total_holders")


def read_holder_sources(spark: SparkSession, sources: dict, limit: int) -> tuple[list[DataFrame], dict]:
    """Call each registered holder source; one that cannot be read is recorded, not fatal."""
    found, problems = [], {}
    for name, read in sources.items():
        try:
            found.append(read(spark, limit))
        except AnalysisException as problem:
            problems[name] = str(problem)
    if problems and not found:
        raise RuntimeError("all asset sources failed")
    return found, problems


def discovered(holders: DataFrame, arrival: Column, chain: str = params.CHAIN,
               provider: str = params.PROVIDER) -> DataFrame:
    """Holder rows as an upsert batch."""
    return holders.select(F.lit(chain).alias("chain"), "address", F.lit(provider).alias("provider"),
                          "asset_id", "balance", arrival.alias("arrival_seq"))


def upsert_monitored(monitored: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """Keyed upsert: new keys enter active, known ones get balance, activity and time.

    Inside the batch the last arrival of a key wins. ``discovered_at`` is kept and
    wallets missing from the batch stay as they are.
    """
    last = limit_per_group(batch, MONITORED_KEY, [F.col("arrival_seq").desc()], 1)
    fresh = last.select(*MONITORED_KEY, F.col("balance").alias("_balance"), F.lit(True).alias("_hit"))
    hit = F.coalesce("_hit", F.lit(False))
    return (monitored.join(fresh, MONITORED_KEY, "full_outer")
            .select(*MONITORED_KEY,
                    F.when(hit, F.col("_balance")).otherwise(F.col("balance")).alias("balance"),
                    (hit | F.coalesce("is_active", F.lit(False))).alias("is_active"),
                    F.coalesce("discovered_at", now).alias("discovered_at"),
                    F.when(hit, now).otherwise(F.col("updated_at")).alias("updated_at")))


def deactivate_addresses(monitored: DataFrame, keys: DataFrame, now: Column) -> DataFrame:
    """Set the listed keys inactive; keys that are not monitored do nothing."""
    listed = keys.select(*MONITORED_KEY).distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    return (monitored.join(listed, MONITORED_KEY, "left")
            .select(*MONITORED_KEY, "balance",
                    (F.col("is_active") & ~hit).alias("is_active"), "discovered_at",
                    F.when(hit, now).otherwise(F.col("updated_at")).alias("updated_at")))


def _active(monitored: DataFrame, chain: str, provider: str) -> DataFrame:
    return monitored.where((F.col("chain") == chain) & (F.col("provider") == provider)
                           & F.col("is_active"))


def active_addresses(monitored: DataFrame, chain: str = params.CHAIN,
                     provider: str = params.PROVIDER) -> DataFrame:
    return _active(monitored, chain, provider).select("address").distinct()


def active_wallet_count(monitored: DataFrame, chain: str = params.CHAIN,
                        provider: str = params.PROVIDER, rsd: float | None = None) -> DataFrame:
    """Distinct active addresses; with ``rsd`` an estimate of that relative deviation."""
    count = (F.count_distinct("address") if rsd is None
             else F.approx_count_distinct("address", rsd))
    return _active(monitored, chain, provider).agg(count.alias("active_wallets"))


def distinct_addresses(df: DataFrame) -> DataFrame:
    return df.select("address").distinct()
