"""Exact duplicates: 128-bit content hash, byte comparison inside each hash group.

Texts are equal when they are identical after lower-casing A-Z only; a NULL text
counts as empty. Copies are folded map-side before anything is shuffled, so a text
that makes up a third of all rows sends one row per task.

Defined results
- NULL id: never chosen while the group has another id; if all are NULL the kept id is NULL.
- Rows that repeat the kept id are the same document: all of them are reported as kept,
  and ``drop_duplicates`` returns one.
- Empty table: empty result. Extra columns do not matter to ``classes`` and pass
  through ``drop_duplicates``.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from walletscope.plans.settle import settle


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _groups(rows: DataFrame, keep: str) -> DataFrame:
    """One row per distinct text: grouping by hash *and* text is the byte comparison."""
    pick = {"smallest": F.min, "largest": F.max}[keep]
    return rows.groupBy("_h", "_t").agg(F.count(F.lit(1)).alias("_n"), pick("_id").alias("_keep"))


def _with_groups(rows: DataFrame, keep: str) -> DataFrame:
    """``rows`` with the size and kept id of each row's group.

    The hash alone joins a row to its group wherever a hash has one text, which is
    settled first. Only texts of hashes shared by different texts travel again.
    """
    texts = settle(_groups(rows, keep).withColumn("_v", F.sha2("_t", 256)).drop("_t"), "dedup-groups")
    hashes = texts.groupBy("_h").agg(F.count(F.lit(1)).alias("_texts"), F.max("_n").alias("_n"),
                                     F.max("_keep").alias("_keep"))
    collided = settle(hashes.filter("_texts > 1").select("_h"), "dedup-collisions")
    if collided.isEmpty():
        return rows.join(texts.select("_h", "_n", "_keep"), "_h")
    plain = rows.join(hashes.filter("_texts = 1").select("_h", "_n", "_keep"), "_h")
    split = rows.join(collided, "_h", "left_semi")
    return plain.unionByName(split.join(_groups(split, keep), ["_h", "_t"]))


def _rows(docs: DataFrame, id_col: str, text_col: str, hashed: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), normalized(F.col(text_col)).alias("_t"))
    return rows.select("_id", "_t", hashed(F.col("_t")).alias("_h"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
            hashed: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    rows = _rows(docs, id_col, text_col, hashed).withColumn("_sha", F.sha2("_t", 256))
    return _with_groups(rows, keep).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                    hashed: Callable[[Column], Column] = hash128) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    kept = (_with_groups(_rows(docs, id_col, text_col, hashed), keep)
            .filter(F.col("_id").eqNullSafe(F.col("_keep"))).select("_h", "_id").distinct())
    keyed = docs.select(F.struct(*docs.columns).alias("_doc"), hashed(normalized(F.col(text_col))).alias("_h"),
                        F.col(id_col).alias("_id"))
    same = keyed["_h"].eqNullSafe(kept["_h"]) & keyed["_id"].eqNullSafe(kept["_id"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["_h", "_id"]).select("_doc.*")
