"""Sharding by a two-pass external shuffle.

Pass one counts the rows of memory-sized buckets, to which a seeded hash of id and
text scatters every record. Pass two moves each record to its bucket, puts the bucket
in a canonical order and shuffles it by Fisher-Yates with a generator seeded by
(seed, bucket). The buckets one after the other are a uniform permutation of all
records; it is cut into shards whose row counts differ by one at most. A lost
executor's tasks give the same rows again, as nothing depends on arrival order.

The hash cannot part rows of equal id and text, so those that would overfill a bucket on their
own are written once with a bucket for each row, and read from there by both passes.

Defined results
- NULL text: no bytes. NULL id: hashed as such. Repeated rows keep their own slots; rows of equal id and
  text may be exchanged for one another, and share a bucket as long as one can hold them.
- Very long texts count with all their bytes; a record above ``bucket_bytes`` makes its bucket that large.
- Fewer rows than shards: the first shards hold one row each. Empty table: empty result.
- Extra columns pass through, except those named like the outputs, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from walletscope.plans.settle import settle

OUTPUTS = ("size", "shard", "slot")


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(16)


def bucket_count(docs: DataFrame, text_col: str, bucket_bytes: int) -> int:
    """As many buckets as keep one within ``bucket_bytes`` on average, at least one per shuffle partition."""
    total = docs.agg(F.sum(record_size(F.col(text_col)))).first()[0] or 0
    return max(-(-total // bucket_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _shuffled(seed: int) -> Callable[[pa.Table], pa.Table]:
    def shuffle(bucket: pa.Table) -> pa.Table:
        canonical = bucket.sort_by([("_key", "ascending"), ("_id_key", "ascending")])
        order = np.arange(len(canonical))
        np.random.default_rng([seed, canonical["_bucket"][0].as_py()]).shuffle(order)  # Fisher-Yates
        at = pa.array(np.arange(len(order)), pa.int64())
        return canonical.take(pa.array(order)).append_column("_at", at)
    return shuffle


def _spread_repeated(keyed: DataFrame, seed: int, buckets: int, bucket_bytes: int) -> DataFrame:
    """``keyed`` with rows that repeat beyond a bucket's bytes dealt over all buckets, copy by copy.

    There are at most total bytes / ``bucket_bytes`` such groups. Their rows are written before anything counts
    them, so a lost task cannot deal them anew.
    """
    same = ["_key", "_id_key"]
    repeated = settle(keyed.groupBy(*same).agg(F.sum("size").alias("_bytes")).where(F.col("_bytes") > bucket_bytes).select(*same),
                      "repeated")
    if repeated.isEmpty():
        return keyed
    copy = F.xxhash64(F.lit(seed), "_key", F.spark_partition_id(), F.monotonically_increasing_id())
    dealt = keyed.join(repeated, same, "left_semi").withColumn("_bucket", F.pmod(copy, F.lit(buckets)))
    return keyed.join(repeated, same, "left_anti").unionByName(settle(dealt, "dealt"))


def shard_documents(docs: DataFrame, shards: int, seed: int = 17, bucket_bytes: int = 64 << 20,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with size, shard (from 0) and slot (gapless from 0 in its shard)."""
    kept = [c for c in docs.columns if c.lower() not in OUTPUTS]
    id_, text = F.col(id_col), F.col(text_col)
    buckets = bucket_count(docs, text_col, bucket_bytes)
    key = F.xxhash64(F.lit(seed), id_, text)
    keyed = docs.select(F.struct(*kept).alias("_row"), record_size(text).alias("size"), key.alias("_key"),
                        F.xxhash64(id_, F.lit(seed)).alias("_id_key"), F.pmod(key, F.lit(buckets)).alias("_bucket"))
    keyed = _spread_repeated(keyed, seed, buckets, bucket_bytes)

    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.orderBy("_bucket")  # over one row per bucket
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                            F.sum("_n").over(everything).alias("_rows"))

    scattered = keyed.join(offsets, "_bucket")
    schema = T.StructType([*scattered.schema.fields, T.StructField("_at", T.LongType())])
    mixed = scattered.groupBy("_bucket").applyInArrow(_shuffled(seed), schema)

    place, rows, n = F.col("_before") + F.col("_at"), F.col("_rows"), F.lit(shards)
    longer = rows % n

    def whole(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    base = whole(rows, n)
    edge = longer * (base + 1)  # the first shards hold one row more
    shard = F.when(place < edge, whole(place, base + 1)).otherwise(
        longer + whole(place - edge, F.greatest(base, F.lit(1))))
    start = shard * base + F.least(shard, longer)
    return mixed.select("_row.*", "size", shard.cast("int").alias("shard"), (place - start).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; rows of a bucket stay together, so each task writes few files."""
    sharded.write.partitionBy("shard").parquet(path)
