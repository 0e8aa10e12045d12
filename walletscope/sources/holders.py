"""Top-holder documents of native and token assets to one row per holder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from walletscope.functions import canonical_integer
from walletscope.sources.documents import with_document

_NATIVE = "array<struct<account: string, balance: string>>"
_JETTON = "struct<jetton_wallets: array<struct<owner: string, balance: string>>>"


def parse_native(docs: DataFrame, asset_id: str = "TON") -> DataFrame:
    """Documents ``[{account, balance}]`` (column ``body``) with parse state and holder array."""
    return (with_document(docs, "body", _NATIVE, "_doc")
            .select(F.lit(asset_id).alias("asset_id"), F.lit("native").alias("asset_type"),
                    F.col("_doc").isNotNull().alias("readable"),
                    F.transform("_doc", lambda h: F.struct(
                        h["account"].alias("address"),
                        canonical_integer(h["balance"]).alias("balance"))).alias("holders")))


def parse_jetton(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Documents ``{jetton_wallets: [{owner, balance}]}`` of the configured tokens.

    ``tokens(master_address, symbol)`` is configuration; documents of other
    tokens are not asked for and drop out. Zero balances are excluded.
    """
    parsed = with_document(docs, "body", _JETTON, "_doc")
    holders = F.transform("_doc.jetton_wallets", lambda h: F.struct(
        h["owner"].alias("address"), canonical_integer(h["balance"]).alias("balance")))
    return (parsed.join(tokens, "master_address")
            .select(F.col("symbol").alias("asset_id"), F.lit("jetton").alias("asset_type"),
                    F.col("_doc").isNotNull().alias("readable"),
                    F.filter(holders, lambda h: h["balance"] != "0").alias("holders")))


def holder_rows(parsed: DataFrame) -> DataFrame:
    """Flat (asset, type, address, balance) rows of readable documents."""
    rows = F.when(F.col("readable"), F.col("holders"))
    return (parsed.select("asset_id", "asset_type", F.explode(rows).alias("_h"))
            .select("asset_id", "asset_type", "_h.address", "_h.balance"))
