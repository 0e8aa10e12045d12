"""Tables bucketed by wallet, so that transactions meet their checkpoints without a shuffle.

Both tables are cut into the same number of buckets by the hash of the wallet and sorted
within. A join by wallet, and a limit per wallet after it, then read bucket by bucket. For wallets
that hold too many rows for one task use ``operators.ingest.fetch_after_checkpoint``, which spreads them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from walletscope import params
from walletscope.operators.ingest import limit_per_group
from walletscope.plans.hot import DEFAULT, HotRule, hot_keys
from walletscope.schemas import WALLET


def write_bucketed(rows: DataFrame, path: str, order: Sequence[str] = (), buckets: int = 64, name: str | None = None) -> DataFrame:
    """Rows as a table bucketed by wallet, under a name of the session's catalog, with its files below ``path``.

    Rows are first dealt by the same hash, so a bucket is one file.
    """
    table = name or f"bucketed_{uuid.uuid4().hex}"
    (rows.repartition(buckets, *WALLET).write.bucketBy(buckets, *WALLET).sortBy(*WALLET, *order)
     .option("path", path).mode("overwrite").saveAsTable(table))
    return rows.sparkSession.table(table)


def fetch_colocated(transactions: DataFrame, checkpoints: DataFrame, limit: int = params.FETCH_LIMIT) -> DataFrame:
    """The next ``limit`` transactions of each wallet after its checkpoint; both tables must be bucketed alike.

    Wallets with NULL parts have no checkpoint.
    """
    joined = transactions.join(checkpoints.select(*WALLET, "last_lt").hint("merge"), WALLET, "left")
    later = joined.where(F.col("last_lt").isNull() | (F.col("lt") > F.col("last_lt"))).drop("last_lt")
    return limit_per_group(later, WALLET, [F.col("lt"), F.col("tx_hash")], limit)


def too_hot(transactions: DataFrame, rule: HotRule = DEFAULT) -> bool:
    """Whether some wallet holds more rows than one task should; then the spread form is the one to use."""
    return not hot_keys(transactions, WALLET, rule).isEmpty()
