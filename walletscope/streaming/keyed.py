"""Checkpoints as keyed stream state: one mark per wallet, whatever the number of batches.

Spark keeps a wallet's mark (and the rivals seen at it) in its state store. A batch's rows of a
wallet meet the mark only; no stored table is read. The output, advances and conflicts, names
every event once: copies of what is below the mark, at it, or already a rival change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from walletscope.schemas import WALLET

OUTCOME = ("chain string, address string, provider string, event_id string, lt bigint, tx_hash string, arrival_seq bigint, "
           "arrived_at timestamp, outcome string")


class Marks(StatefulProcessor):
    """The mark of a wallet (largest lt, and the hash that came first for it) and the rivals met at it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "lt bigint, tx_hash string")
        self.rivals = handle.getMapState("rivals", "event_id string", "met boolean")

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self.mark.update((initialState.lt, initialState.tx_hash))
        for event in initialState.rivals:
            self.rivals.updateValue((event,), (True,))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        """Rows below the mark can never count and are passed over; the others of this batch are taken by arrival.

        Every call of the state goes to Spark and back, so it is asked once per wallet and batch: a mark of this
        batch and its rivals are kept aside until the wallet's last row.
        """
        stored = mark = self.mark.get()
        met: set[str] | None = None  # rivals of a mark of this batch; those of the stored mark are in the state
        near = sorted((r for r in rows if mark is None or r.lt >= mark[0]), key=lambda r: r.arrival_seq)
        chain, address, provider = key
        for r in near:
            outcome = None
            if mark is None or r.lt > mark[0]:
                mark, met, outcome = (r.lt, r.tx_hash), set(), "advance"
            elif r.lt == mark[0] and r.tx_hash != mark[1]:
                if met is None:
                    if not self.rivals.containsKey((r.event_id,)):
                        self.rivals.updateValue((r.event_id,), (True,))
                        outcome = "conflict"
                elif r.event_id not in met:
                    met.add(r.event_id)
                    outcome = "conflict"
            if outcome:
                yield Row(chain=chain, address=address, provider=provider, event_id=r.event_id, lt=r.lt, tx_hash=r.tx_hash,
                          arrival_seq=r.arrival_seq, arrived_at=r.arrived_at, outcome=outcome)
        if met is not None:
            if stored is not None:
                self.rivals.clear()
            for event in met:
                self.rivals.updateValue((event,), (True,))
            self.mark.update(mark)

    def close(self) -> None:
        pass


def state_of(outcomes: DataFrame) -> DataFrame:
    """Marks and rivals of every wallet, from the outcomes of earlier streams: what a new log starts from."""
    top = F.max(F.struct("lt", (-F.col("arrival_seq")).alias("seq"), "tx_hash")).alias("_top")
    marks = outcomes.where(F.col("outcome") == "advance").groupBy(*WALLET).agg(top).select(*WALLET, "_top.lt", "_top.tx_hash")
    met = (outcomes.where(F.col("outcome") == "conflict").groupBy(*WALLET, "lt").agg(F.collect_set("event_id").alias("rivals")))
    return marks.join(met, [*WALLET, "lt"], "left").select(
        *WALLET, "lt", "tx_hash", F.coalesce("rivals", F.array().cast("array<string>")).alias("rivals"))


def outcomes(arrivals: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Advances and conflicts of a stream of arrivals; ``known`` outcomes seed the state of a new log.

    Only narrow columns enter the state's shuffle. A wallet's rows of one micro-batch at or above its
    mark are sorted in memory, so a source with hot wallets needs a limit per trigger.
    """
    narrow = arrivals.where("event_id IS NOT NULL AND lt IS NOT NULL").select(
        *WALLET, "event_id", "lt", "tx_hash", "arrival_seq", "arrived_at")
    start = None if known is None else state_of(known).groupBy(*WALLET)
    return narrow.groupBy(*WALLET).transformWithState(Marks(), OUTCOME, "append", "none", start)


def checkpoints(found: DataFrame) -> DataFrame:
    """The checkpoint of each wallet, from all outcomes so far."""
    top = F.max(F.struct("lt", (-F.col("arrival_seq")).alias("seq"), "tx_hash", "arrived_at")).alias("_top")
    return (found.where(F.col("outcome") == "advance").groupBy(*WALLET).agg(top)
            .select(*WALLET, F.col("_top.lt").alias("last_lt"), F.col("_top.tx_hash").alias("last_hash"),
                    F.col("_top.arrived_at").alias("updated_at")))
