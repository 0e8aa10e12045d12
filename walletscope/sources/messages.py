"""Event messages: snake_case JSON bodies to the message struct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from walletscope import schemas
from walletscope.sources.documents import with_document

REQUIRED = [f for f in schemas.MESSAGE_FIELDS if f != "correlation_id"]


def stream_bodies(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Message bodies as text lines of a landing folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def stream_kafka(spark: SparkSession, **options: str) -> DataFrame:
    """Message bodies of a topic; needs the Kafka connector on the class path."""
    return (spark.readStream.format("kafka").options(**options).load()
            .select(F.col("value").cast("string").alias("value")))


def decode(bodies: DataFrame, body: str = "value") -> DataFrame:
    """Add ``message`` and ``problem``.

    ``undecodable`` is a body that decodes to nothing (``null``) and is dead at
    once; ``malformed`` is broken JSON or a missing required field and is retried.
    """
    parsed = with_document(bodies, body, f"struct<{schemas.EVENT_MESSAGE}>", "_msg")
    missing = F.lit(False)
    for name in REQUIRED:
        missing = missing | F.col(f"_msg.{name}").isNull()
    problem = (F.when(F.trim(body) == "null", "undecodable")
               .when(F.col("_msg").isNull() | missing, "malformed"))
    return (parsed.withColumn("problem", problem)
            .withColumn("message", F.when(F.col("problem").isNull(), F.col("_msg"))).drop("_msg"))


def failed_attempts(bodies: DataFrame, body: str = "value") -> DataFrame:
    """One row per delivery (queue, message_id, body) whose body is no message.

    These are the attempts that decide on retries and dead letters.
    """
    return (decode(bodies, body).select(
        "queue", "message_id", F.explode(F.when(F.col("problem").isNotNull(), F.array("problem"))).alias("problem"))
        .select("queue", "message_id", (F.col("problem") == "undecodable").alias("undecodable")))


def messages(bodies: DataFrame, body: str = "value") -> DataFrame:
    """The decodable messages.

    Chosen in a generator: a filter on the outcome would be pushed down and
    decode every body twice.
    """
    decoded = decode(bodies, body)
    return decoded.select(F.inline(F.when(F.col("message").isNotNull(), F.array("message"))))
