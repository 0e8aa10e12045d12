"""Event documents stored once as shredded variants, and alerts read from their columns.

``store`` parses each document once more, by the strict entry of all sources, and splits the stored events into
documents of the usual form, kept as a variant that Spark shreds into typed Parquet columns, and all
others, kept as text. An alert query then reads the message columns and the few odd texts, not the
documents (``raw_json`` stays beside them for readers of whole documents). ``evaluate_stored`` gives what
``alerts.evaluate`` gives, whatever the threshold, as odd documents go through that.

Defined results
- A document is of the usual form if its transactions, messages and message lists are objects and lists,
  no member of a message is null, and every value is text or a whole number of at most 64 bits that a decimal
  of 29 digits holds. NULL texts, broken texts and all other documents are odd.
- Empty tables, repeated rows and very long documents are stored as they are. Columns of the events that are named
  like the stored ones (``document``, ``odd_json``, ``largest_nano``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from walletscope import params
from walletscope.operators import alerts
from walletscope.operators.alerts import _HITS, _MESSAGE, _PARTS, _child, _kind, _least_nano, _messages, _qualifying
from walletscope.functions.amounts import INTEGER
from walletscope.session import require_prepared
from walletscope.sources.documents import with_document

STORED = ("document", "odd_json", "largest_nano")
_NANO = "decimal(29,0)"


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _absent_or(value: Column, condition: Column) -> Column:
    return value.isNull() | _true(condition)


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _usual_message(message: Column) -> Column:
    amount = _child(message, "value")
    side = [_absent_or(_child(message, name), _kind(_child(message, name)) != "VOID") for name in ("source", "destination")]
    return _true(_kind(message).startswith("OBJECT")) & _absent_or(amount, _kind(amount).isin("STRING", "BIGINT")) & side[0] & side[1]


def _usual_parts(owner: Column) -> Column:
    """Whether a transaction, or a document that stands for one, has messages of the usual form."""
    incoming, outgoing = _child(owner, "in_msg"), _child(owner, "out_msgs")
    return (_true(_kind(owner).startswith("OBJECT")) & _absent_or(incoming, _usual_message(incoming))
            & _absent_or(outgoing, F.forall(_list(outgoing), _usual_message)))


def _usual(document: Column) -> Column:
    listed = _child(document, "transactions")
    return _usual_parts(document) & _absent_or(listed, F.forall(_list(listed), _usual_parts))


def _stored_messages(document: Column) -> Column:
    """The messages of a usual document; only the paths named here are read from the file."""
    listed = F.try_variant_get(document, "$.transactions", f"array<struct<{_PARTS}>>")
    alone = F.struct(F.try_variant_get(document, "$.in_msg", _MESSAGE).alias("in_msg"),
                     F.try_variant_get(document, "$.out_msgs", f"array<{_MESSAGE}>").alias("out_msgs"))
    return F.flatten(F.transform(F.when(listed.isNotNull(), listed).otherwise(F.array(alone)), _messages))


def shred(events: DataFrame) -> DataFrame:
    """``events`` with their document as a variant or as odd text, and the largest amount of a usual one."""
    require_prepared(events.sparkSession)
    kept = events.select(*[c for c in events.columns if c.lower() not in STORED])
    read = with_document(kept, "raw_json", "variant", "_doc").withColumn("_usual", _usual(F.col("_doc")))
    read = read.withColumn("_all", F.when(F.col("_usual"), _stored_messages(F.col("_doc"))))
    texts = F.filter(F.transform("_all", lambda m: F.regexp_extract(m["digits"], INTEGER, 1)), lambda d: d != "")
    read = read.withColumn("_nano", F.transform(texts, lambda d: d.try_cast(_NANO))).drop("_all")
    narrow = F.forall("_nano", lambda n: n.isNotNull() & (F.abs(n) <= F.lit(params.MAX_DECIMAL_UNITS).cast(_NANO)))
    usual = _true(F.col("_usual") & narrow)
    return read.select(*kept.columns, F.when(usual, F.col("_doc")).alias("document"),
                       F.when(~usual, F.col("raw_json")).alias("odd_json"),
                       F.when(usual, F.array_max("_nano")).alias("largest_nano"))


def store(events: DataFrame, path: str) -> None:
    shred(events).write.parquet(path)


def read_stored(spark: SparkSession, path: str, events: T.StructType) -> DataFrame:
    """Stored events of the given columns, with their documents."""
    fields = [f for f in events.fields if f.name.lower() not in STORED]
    added = [T.StructField("document", T.VariantType()), T.StructField("odd_json", T.StringType()),
             T.StructField("largest_nano", T.DecimalType(29, 0))]
    return spark.read.schema(T.StructType(fields + added)).parquet(path)


def evaluate_stored(stored: DataFrame, threshold=params.ALERT_THRESHOLD) -> DataFrame:
    """``status`` and ``hits`` of stored events, as ``alerts.evaluate`` gives them for whole pages."""
    columns = [c for c in stored.columns if c not in (*STORED, "raw_json")]
    usual = F.col("document").isNotNull()
    found = F.when(usual, _qualifying(_stored_messages(F.col("document")), threshold))
    read = stored.select(*columns, usual.alias("_usual"), found.alias("_leaf_hits"), F.col("odd_json").alias("raw_json"))
    judged = alerts.evaluate(read, threshold)
    broken = F.exists("_leaf_hits", lambda a: a["error"])
    status = F.when(~F.col("_usual"), F.col("status")).when(broken, params.EVALUATION_ERROR).otherwise("ok")
    hits = F.when(~F.col("_usual"), F.col("hits")).when(~broken, F.col("_leaf_hits")).cast(_HITS)
    return judged.select(*columns, status.alias("status"), hits.alias("hits"))


def stored_alerts(stored: DataFrame, threshold=params.ALERT_THRESHOLD, asset_id: str = params.ALERT_ASSET,
                  extra: tuple[str, ...] = ()) -> DataFrame:
    """``alerts.whale_alerts`` of stored events; documents whose largest amount is too small are skipped."""
    least = _least_nano(threshold)
    likely = stored.where(F.col("odd_json").isNotNull() | (F.col("largest_nano") >= F.lit(least).cast(_NANO)))
    return alerts.alert_rows(evaluate_stored(likely, threshold), asset_id, extra)
