"""Transaction pages: landing-zone documents of one wallet to one row per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from walletscope.functions import sanitize_json
from walletscope.sources.documents import with_document

PAGE_FILE = "chain string, provider string, address string, body string"
_TXS = "array<struct<lt: bigint, hash: string, utime: bigint>>"
_PAGE = f"struct<transactions: {_TXS}>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landing zone of JSON lines, one page document per line."""
    return spark.read.schema(PAGE_FILE).json(path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (spark.readStream.schema(PAGE_FILE)
            .option("maxFilesPerTrigger", files_per_batch).json(path))


def with_transactions(pages: DataFrame) -> DataFrame:
    """Add ``txs``: the page's transactions, NULL for a page that fails as a whole.

    A page is one strict document with the member ``transactions``, and counts only if
    every transaction has its three required fields. The member may be null, as may the
    whole document; such a page is empty.
    """
    listed = F.col("_page.transactions")
    named = F.array_contains(F.json_object_keys("body"), "transactions")
    empty = (F.trim("body") == "null") | (F.col("_page").isNotNull() & listed.isNull() & named)
    gap = F.exists(
        listed, lambda t: t.isNull() | t["lt"].isNull() | t["hash"].isNull() | t["utime"].isNull())
    return (with_document(pages, "body", _PAGE, "_page")
            .withColumn("txs", F.when(empty, F.array().cast(_TXS)).when(~gap, listed)).drop("_page"))


def transactions(pages: DataFrame) -> DataFrame:
    """One row per transaction of every whole page.

    The body is cleaned once per page, before it is repeated on the page's rows.
    """
    rows = F.coalesce("txs", F.array().cast(_TXS))
    return (with_transactions(pages).withColumn("body", sanitize_json(F.col("body")))
            .select("chain", "provider", "address", "body", F.explode(rows).alias("_tx"))
            .select("chain", "provider", "address", F.col("_tx.lt").alias("lt"),
                    F.col("_tx.hash").alias("tx_hash"), F.col("_tx.utime").alias("utime"), "body"))


def bad_pages(pages: DataFrame) -> DataFrame:
    """Pages that fail as a whole, kept for inspection instead of vanishing."""
    return with_transactions(pages).where(F.col("txs").isNull()).drop("txs")
