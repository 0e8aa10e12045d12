"""Session helpers: the settings that results rest on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Settings that decide results: times are UTC instants, and of equal keys in a JSON object the last
#: one counts, inside variants as elsewhere.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}

#: Where streams keep their state: on the executors' disks, with changes below the checkpoint folder.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

#: Lets ``sources.landing`` see the filters of a read.
SOURCE_FILTERS = ("spark.sql.python.filterPushdown.enabled", "true")


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on, once per session and before any of them."""
    for name, value in (*SETTINGS.items(), STATE_STORE, SOURCE_FILTERS):
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def require_prepared(spark: SparkSession) -> None:
    """Operators do not change the session; they refuse one in which results would differ."""
    wrong = [name for name, value in SETTINGS.items() if spark.conf.get(name, None) != value]
    if wrong:
        raise ValueError(f"call walletscope.session.prepare(spark) first: {', '.join(wrong)}")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for stream state and outputs, below the cluster's checkpoint folder.

    Every executor must reach it, so the session's ``spark.checkpoint.dir`` decides.
    Only where that is unset and Spark runs in one local process (tests) is a
    temporary folder used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="walletscope-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
