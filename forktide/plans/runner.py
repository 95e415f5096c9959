"""The live run over a node: a trigger, startup, reconcile, verification and health.

The trigger is a streaming query whose micro-batches carry no data: at most one runs at a time, and what fires meanwhile is one
wake-up, not many.  All state is in the store, so a restart begins where the last commit ended.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forktide.operators import journal
from forktide.operators.transition import MAX_DEPTH, CrossesFinalized, DepthExceeded, Header, MissingParent, state_of
from forktide.sources.rpc import BLOCKS, LOGS, Client, RpcError

from .backfill import matched, store_rows, timed
from .compaction import Compactor
from .live import Report, Tracker, startup_batch
from .ranges import BackfillError
from .snapshot import Store, StoreBusy, StoreError
from .status import Health, Series, Status


@dataclass
class RpcSource:
    """A node as the tracker's source."""

    store: Store
    client: Client
    contracts: DataFrame | None = None
    status: str = "unsafe"

    def head(self) -> Header:
        found = self.client.head()
        at = self.header_by_hash(found["block_hash"])
        if at is None:
            raise RpcError("the node no longer knows its head")
        return at

    def header_at(self, height: int) -> Header | None:
        row = self.client.find_block(height)
        return row and Header(row[1], row[2], row[0])

    def header_by_hash(self, block_hash: str) -> Header | None:
        return self.client.header_by_hash(block_hash)

    def payload(self, headers: list[Header]) -> tuple[DataFrame, DataFrame]:
        """Blocks and logs of a batch's applied headers, asked for by hash, so that they can't be another branch's.

        A node that answers with other headers is asked once more; then it is an error.
        """
        blocks, logs = [], []
        for h in headers:
            for attempt in range(2):
                rows, found = self.client.block_by_hash(h.block_hash), self.client.logs_of(h)
                if rows and Header(rows[0][1], rows[0][2], rows[0][0]) == h and matched(rows, found):
                    break
                if attempt:
                    raise RpcError(f"block {h.block_hash} and its logs don't belong together")
            blocks += rows
            logs += found
        spark = self.store.spark
        return store_rows(spark.createDataFrame(timed(blocks), BLOCKS), spark.createDataFrame(logs, LOGS), self.status, self.contracts)


def recent_disagreements(store: Store, verifier, last: int) -> int:
    """How many of the last committed headers the verifier has with another hash; a header that it lacks is none, a verifier that fails is one."""
    at = store.checkpoint()
    if at is None:
        return 0
    rows = store.blocks(at.height - last + 1, at.height).where("is_canonical").select("height", "block_hash").collect()  # ``last`` rows at most
    try:
        theirs = {r["height"]: verifier.header_at(r["height"]) for r in rows}
    except (RpcError, OSError):
        return 1
    return sum(1 for r in rows if (other := theirs[r["height"]]) is not None and other.block_hash != r["block_hash"])


@dataclass
class Live:
    tracker: Tracker
    status: Status = field(default_factory=Status)
    #: Committed headers that the verifier is asked for after each step.
    verify_last: int = 12
    #: Does a piece of work on the store after each step.
    compactor: Compactor | None = None
    #: A table to which each step adds a row; see ``status.Series``.
    series: Series | None = None
    started: bool = False

    @property
    def health(self) -> Health:
        return self.status.health

    def start(self) -> None:
        """Bring a stored chain in line with the source: back to the last common header, then up, in one commit."""
        store, tracker = self.tracker.store, self.tracker
        at = store.checkpoint()
        if at is not None:
            finalized = None if tracker.finalized_depth is None else max(0, at.height - tracker.finalized_depth)
            state = state_of(store.blocks(at.height - (tracker.max_depth or MAX_DEPTH) - 1, at.height), at.height, tracker.max_depth or MAX_DEPTH, finalized)
            batch = startup_batch(state, tracker.source, tracker.max_depth)
            if finalized is not None and batch.ancestor is not None and batch.ancestor.height < finalized:
                raise CrossesFinalized(f"the source parts from the store at {batch.ancestor.height}, below the finalized {finalized}")
            tracker.commit(batch, Report())
        self.started = True

    def step(self) -> Report:
        """A step, its row in the series, and a piece of compaction."""
        try:
            report = self._step()
        except Exception as e:
            if self.series is not None:
                self.series.add(self.status, Report("unavailable", f"{type(e).__name__}: {e}"))
            raise
        if self.series is not None:
            self.series.add(self.status, report)
        if self.compactor is not None and report.state == "ready":
            self.compactor.step()
        return report

    def _step(self) -> Report:
        """One wake-up.  An error of the node, or another writer at work, degrades the health and passes; a broken chain stops it for good."""
        if self.health.stopped:
            return Report("unavailable", self.health.reason)
        try:
            if not self.started:
                self.start()
            report = self.tracker.reconcile()
            if report.state not in ("unavailable", "halted"):
                self._note(report)
                return report
        except (RpcError, OSError, BackfillError, StoreBusy) as e:
            self.health.set("degraded", str(e))
            return Report("degraded", str(e))
        except (DepthExceeded, CrossesFinalized, MissingParent, StoreError) as e:
            report = Report("unavailable", f"{type(e).__name__}: {e}")
        self.health.correctness_stop(report.reason)
        return report

    def _note(self, report: Report) -> None:
        s, store = self.status, self.tracker.store
        at = store.checkpoint()
        s.checkpoint_height, s.head_height = at and at.height, self.tracker.source.head().height
        if report.rolled_back:
            s.reorgs, s.reorg_depth = s.reorgs + 1, max(len(report.rolled_back), len(report.applied))
        if self.tracker.verifier is not None:
            report.disagreements = max(report.disagreements, recent_disagreements(store, self.tracker.verifier, self.verify_last))
            s.disagreements = report.disagreements
        left = journal.backlog(store.pending(store.unpublished()).withColumn("published_at", F.lit(None).cast("timestamp")), store.now()).first()
        s.n_unpublished, s.oldest_age_s = left["n_unpublished"], left["oldest_age_s"]
        ready = report.state == "ready" and not s.disagreements and not s.gaps
        self.health.set("ready" if ready else "degraded", report.reason or ("the verifier disagrees" if s.disagreements else None))

    def stream(self, poll_seconds: float = 12.0, checkpoint: str | None = None) -> StreamingQuery:
        """Steps every ``poll_seconds`` until the query is stopped or the health stops for good."""
        ticks = self.tracker.store.spark.readStream.format("rate").option("rowsPerSecond", 1).load()

        def wake(_: DataFrame, __: int) -> None:
            self.step()
            if self.health.stopped:
                raise RuntimeError(self.health.reason)

        writer = ticks.writeStream.foreachBatch(wake).trigger(processingTime=f"{poll_seconds} seconds")
        return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
