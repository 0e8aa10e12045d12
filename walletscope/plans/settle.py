"""Cut a plan at a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from walletscope.session import shared_dir


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back.

    For results that later steps read several times: each reader then scans only
    the columns it needs, nothing upstream runs twice, and the files survive the
    loss of any executor.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
