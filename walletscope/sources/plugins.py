"""Plug-in points: sources, alert rules and sinks are callables over DataFrames.

Whatever has the right columns takes part: event sources in ``event_transactions``, holder
sources in ``operators.monitored.read_holder_sources``, rules and sinks in
``streaming.runs.handle``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

#: Pages or transactions of a provider, with chain, provider and address.
EventSource = Callable[[SparkSession], DataFrame]
#: Parsed holder documents, at most the given number of holders each.
HolderSource = Callable[[SparkSession, int], DataFrame]
#: Alerts of judged events, in the columns of ``operators.alerts.alert_rows``.
AlertRule = Callable[[DataFrame], DataFrame]
#: Takes the alerts of a batch and the batch's name; called again with both if the batch is replayed.
AlertSink = Callable[[DataFrame, str], None]


def event_transactions(spark: SparkSession, sources: Mapping[str, EventSource]) -> DataFrame:
    """The rows of all event sources; their order of names decides nothing."""
    return reduce(DataFrame.unionByName, [read(spark) for read in sources.values()])
