"""The operator's diagnostic queries over the four stored tables.

Every listing with a limit has a full tie-break, so results do not depend on
partitioning. None of them reads ``raw_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from walletscope import params


def addresses_per_asset(monitored: DataFrame) -> DataFrame:
    return (monitored.where("is_active").groupBy("asset_id")
            .agg(F.count("*").alias("total_addresses"),
                 F.count_distinct("address").alias("unique_addresses"))
            .orderBy(F.desc("total_addresses"), "asset_id"))


def multi_asset_wallets(monitored: DataFrame, top: int = 10) -> DataFrame:
    """Wallets holding several assets.

    The lists are built only for the reported wallets, so no list of another
    (possibly very large) wallet is ever collected. ``top`` rows are broadcast.
    """
    active = monitored.where("is_active").select("address", "asset_id")
    ranked = (active.groupBy("address").agg(F.count_distinct("asset_id").alias("asset_count"))
              .where(F.col("asset_count") > 1)
              .orderBy(F.desc("asset_count"), "address").limit(top))
    return (active.join(F.broadcast(ranked), "address")
            .groupBy("address", "asset_count")
            .agg(F.expr("listagg(asset_id, ', ') WITHIN GROUP (ORDER BY asset_id)").alias("assets"))
            .orderBy(F.desc("asset_count"), "address"))


def top_balances_per_asset(monitored: DataFrame, top: int = 5) -> DataFrame:
    """Largest balances per chain and asset, ranked by text width, then numeric value."""
    order = [F.length("balance").desc(), F.col("balance").try_cast("decimal(38,0)").desc_nulls_last(),
             F.col("balance").desc(), F.col("address"), F.col("provider")]
    rank = F.row_number().over(Window.partitionBy("chain", "asset_id").orderBy(*order))
    return (monitored.where("is_active").withColumn("rank", rank).where(F.col("rank") <= top)
            .select("chain", "asset_id", F.left("address", F.lit(42)).alias("wallet"),
                    F.left("balance", F.lit(22)).alias("balance"), "rank")
            .orderBy("chain", "asset_id", "rank"))


def events_summary(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total_events"),
        F.count_distinct("address").alias("addresses_with_events"),
        F.count_distinct("event_id").alias("unique_event_ids"),
        F.min("created_at").alias("first_event"), F.max("created_at").alias("last_event"))


def events_per_address(events: DataFrame, top: int = 10) -> DataFrame:
    return (events.groupBy("address").agg(F.count("*").alias("event_count"))
            .orderBy(F.desc("event_count"), "address").limit(top))


def unprocessed_wallets(monitored: DataFrame, events: DataFrame) -> DataFrame:
    """Active (address, asset, balance) rows whose address has no event.

    Event addresses are made distinct first: an anti join needs each once, and a
    wallet with very many events then reaches the join as one row.
    """
    seen = events.select("address").distinct()
    return (monitored.where("is_active").select("address", "asset_id", "balance")
            .join(seen, "address", "left_anti").distinct())


def unprocessed_addresses(monitored: DataFrame, events: DataFrame, top: int = 10) -> DataFrame:
    return (unprocessed_wallets(monitored, events)
            .orderBy("address", "asset_id", "balance").limit(top)
            .select("address", "asset_id", F.left("balance", F.lit(20)).alias("balance")))


def checkpoint_progress(checkpoints: DataFrame) -> DataFrame:
    key = F.struct("chain", "address", "provider")
    return checkpoints.agg(F.count("*").alias("total_checkpoints"),
                           F.count_distinct(key).alias("unique_addresses"))


def latest_checkpoints(checkpoints: DataFrame, top: int = 10) -> DataFrame:
    return (checkpoints.orderBy(F.desc("updated_at"), "chain", "address", "provider").limit(top)
            .select("chain", F.left("address", F.lit(20)).alias("address"), "last_lt", "last_hash",
                    "updated_at"))


def checkpoint_coverage(monitored: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Active addresses against checkpoint rows.

    The two counts have different grain, so the difference may be negative and is
    reported as it is.
    """
    held = checkpoints.agg(F.count("*")).scalar()
    return (monitored.where("is_active")
            .agg(F.count_distinct("address").alias("total_addresses"))
            .withColumn("checkpointed_addresses", held)
            .withColumn("not_checkpointed",
                        F.col("total_addresses") - F.col("checkpointed_addresses")))


def active_leases(leases: DataFrame, as_of: Column, top: int = 5) -> DataFrame:
    return (leases.where(F.col("expires_at") > as_of)
            .orderBy(F.desc("expires_at"), "lease_key").limit(top)
            .select("lease_key", "owner_id", "expires_at"))


def duplicate_event_ids(events: DataFrame, top: int = 10) -> DataFrame:
    """Event ids stored more than once; empty behind the idempotent sink."""
    return (events.groupBy("event_id").agg(F.count("*").alias("duplicates"))
            .where(F.col("duplicates") > 1).orderBy("event_id").limit(top))


def discovery_freshness(monitored: DataFrame) -> DataFrame:
    return (monitored.where("is_active").groupBy("asset_id")
            .agg(F.min("discovered_at").alias("oldest_discovery"),
                 F.max("discovered_at").alias("newest_discovery")))


def discovery_limit_check(monitored: DataFrame, limit: int = params.DISCOVERY_LIMIT) -> DataFrame:
    status = F.when(F.col("count") > limit, params.OVER_LIMIT_LABEL).otherwise(params.WITHIN_LIMIT_LABEL)
    return (monitored.where("is_active").groupBy("chain", "asset_id").agg(F.count("*").alias("count"))
            .withColumn("status", status).orderBy(F.desc("count"), "chain", "asset_id"))


def system_summary(monitored: DataFrame, events: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Five labelled totals as text; the monitored table is read once for three of them."""
    held = monitored.where("is_active").agg(
        F.count("*").cast("string").alias("Monitored Addresses"),
        F.count_distinct("address").cast("string").alias("Unique Wallets"),
        F.count_distinct("asset_id").cast("string").alias("Assets Tracked"))
    rows = held.unpivot([], held.columns, "metric", "value")
    for label, table in (("Total Events", events), ("Addresses Checkpointed", checkpoints)):
        rows = rows.unionByName(table.agg(F.count("*").cast("string").alias("value"))
                                .select(F.lit(label).alias("metric"), "value"))
    return rows


def top_balances(monitored: DataFrame, top: int = 10, mode: str = "numeric") -> DataFrame:
    """Largest balances of all rows; ``mode="text"`` compares the stored text as it is."""
    if mode == "numeric":
        order = [F.length("balance").desc(),
                 F.col("balance").try_cast("decimal(38,0)").desc_nulls_last()]
    elif mode == "text":
        order = []
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return (monitored.orderBy(*order, F.desc("balance"), "address", "asset_id").limit(top)
            .select("address", "balance"))


def event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("event_count"))
