"""Scans of the stored tables and metric samples (parquet; JDBC where a database holds them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from walletscope import schemas

TABLES = {
    "events": schemas.EVENTS,
    "checkpoints": schemas.CHECKPOINTS,
    "monitored_addresses": schemas.MONITORED_ADDRESSES,
    "address_leases": schemas.ADDRESS_LEASES,
    "metric_samples": schemas.METRIC_SAMPLES,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One stored table; the fixed schema saves the inference pass and keeps column pruning."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """The same table from a relational store; partition options pass through to the reader."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
