"""Event messages as snake_case JSON with message and correlation ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from walletscope import schemas
from walletscope.functions import correlation_id

_ISO = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Messages per file.
FILE_ROWS = 50_000


def encode(messages: DataFrame) -> DataFrame:
    """Rows ``(message_id, correlation_id, content_type, value)`` of messages to publish.

    The message's own correlation id is kept; without one a fresh id is given, to
    the header and the body alike.
    """
    stamped = messages.withColumn("correlation_id", correlation_id("correlation_id"))
    body = F.to_json(F.struct(*schemas.MESSAGE_FIELDS), _ISO)
    return stamped.select(F.uuid().alias("message_id"), "correlation_id",
                          F.lit("application/json").alias("content_type"), body.alias("value"))


def write_files(encoded: DataFrame, path: str) -> None:
    """JSON lines, compressed: every event of a page repeats the page's body.

    Such files are not cut when they are read, so their rows are limited and any task can take one.
    """
    (encoded.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(path))


def stream_kafka(encoded: DataFrame, checkpoint: str, **options: str):
    """Publish to a topic; needs the Kafka connector on the class path."""
    rows = encoded.select(F.col("message_id").alias("key"), "value")
    return (rows.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start())
