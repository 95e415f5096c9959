"""The live tracker: from an observed head to committed batches, one reconcile a call.

The source answers head(), header_at(height), header_by_hash(hash) and payload(headers) -> (blocks, logs).  Choices where
published behaviour conflicts: a source that lags on the same fork is stale and rolls nothing back; a verifier's mismatch
counts once; the finalized guard is wired to the finalized depth.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame

from forktide.operators.transition import Batch, ChainState, CrossesFinalized, DepthExceeded, Event, Header, MissingParent, plan_transition, state_of
from forktide.sources.rpc import RpcError

from .snapshot import Store


class Source(Protocol):
    def head(self) -> Header: ...

    def header_at(self, height: int) -> Header | None: ...

    def header_by_hash(self, block_hash: str) -> Header | None: ...

    def payload(self, headers: list[Header]) -> tuple[DataFrame, DataFrame]: ...


@dataclass
class Report:
    state: str = "ready"
    reason: str | None = None
    applied: list[int] = field(default_factory=list)
    rolled_back: list[int] = field(default_factory=list)
    disagreements: int = 0


@dataclass
class Tracker:
    store: Store
    source: Source
    start: int | None = None
    max_depth: int = 2048
    finalized_depth: int | None = None
    verifier: Source | None = None

    def reconcile(self) -> Report:
        """Bring the store to the source's head, or say why not; nothing is written when it halts."""
        report, head, at = Report(), self.source.head(), self.store.checkpoint()
        if self.verifier is not None:
            report.disagreements = int(self._disagrees(head))
        if at is None:
            if self.start is None:
                return Report("halted", "no checkpoint and no explicit start")
            if self.start > 0:
                return Report("halted", "a start above 0 needs a stored anchor")
            first = self.source.header_at(0)
            self.commit(Batch("bootstrap", None, (Event("apply", first),)), report)
            at = first
        if head.height < at.height and (same := self.source.header_at(head.height)) and self._stored(head.height) == same:
            report.state, report.reason = "degraded", "the source lags behind on the same fork"
            return report
        try:
            while head.height > at.height:
                following = self.source.header_at(at.height + 1)
                if following is None or following.parent_hash != at.block_hash:
                    break
                self.commit(Batch("extend", at, (Event("apply", following),)), report)
                at = following
            if at.block_hash != head.block_hash:
                head = self.source.head()
                finalized = None if self.finalized_depth is None else max(0, at.height - self.finalized_depth)
                state = state_of(self.store.blocks(at.height - self.max_depth - 1, at.height), at.height, self.max_depth, finalized)
                batch = plan_transition(state, head, self.source.header_by_hash, self.max_depth)
                if any(e.kind == "rollback" for e in batch.events):
                    report.applied.clear()
                self.commit(batch, report)
        except (DepthExceeded, CrossesFinalized, MissingParent) as e:
            report.state, report.reason = "unavailable", f"{type(e).__name__}: {e}"
        return report

    def _disagrees(self, head: Header) -> bool:
        """Whether the verifier has another block there; one that can't be asked is a disagreement too, and no reason to stop."""
        try:
            other = self.verifier.header_at(head.height)
        except (RpcError, OSError):
            return True
        return other is not None and other.block_hash != head.block_hash

    def _stored(self, height: int) -> Header | None:
        row = self.store.blocks(height, height).where("is_canonical").select("block_hash", "parent_hash", "height").first()
        return Header(*row) if row else None

    def commit(self, batch: Batch, report: Report) -> None:
        if not batch.events:
            return
        applied = [e.header for e in batch.events if e.kind == "apply"]
        blocks, logs = self.source.payload(applied)
        self.store.commit(batch, blocks, logs)
        report.applied += [h.height for h in applied]
        report.rolled_back += [e.header.height for e in batch.events if e.kind == "rollback"]


def startup_batch(stored: ChainState, source: Source, max_depth: int) -> Batch:
    """Walk back from the checkpoint to the first height where the source has the whole header alike, then up to its head.

    A height that is missing on either side, or a walk longer than max_depth, is an error.
    """
    head, at, back = source.head(), stored.tip, []
    if head.height < at.height and source.header_at(head.height) == stored.canonical.get(head.height):
        return Batch("duplicate", stored.canonical[head.height])
    while True:
        other = source.header_at(at.height)
        if other == at:
            break
        if other is None and at.height <= head.height:
            raise MissingParent(f"the source lacks height {at.height}")
        back.append(Event("rollback", at))
        if len(back) > max_depth:
            raise DepthExceeded(f"no common header within {max_depth} blocks")
        at = stored.canonical.get(at.height - 1)
        if at is None:
            raise MissingParent("the walk left the stored headers")
    forth = [source.header_at(h) for h in range(at.height + 1, head.height + 1)]
    if None in forth:
        raise MissingParent("the source lacks a height below its head")
    events = (*back, *(Event("apply", h) for h in forth))
    return Batch("reorg" if back else "gap" if forth else "duplicate", at, events)
