"""From a new head to an ordered list of rollbacks and applies.

``plan_transition`` works on the driver: a reorganisation is at most ``max_depth`` headers (2048 by default), whatever the table
holds, and its parents come one by one from a resolver.  ``reorg_plan`` is the same for two branches that are both
stored, as one recursive query, and serves as its check.  State changes only when a whole batch has been planned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MAX_DEPTH = 2048


class TransitionError(ValueError):
    pass


class MissingParent(TransitionError):
    pass


class InvalidHeight(TransitionError):
    pass


class DepthExceeded(TransitionError):
    pass


class CrossesFinalized(TransitionError):
    pass


@dataclass(frozen=True)
class Header:
    block_hash: str
    parent_hash: str
    height: int


@dataclass(frozen=True)
class Event:
    kind: str
    header: Header


@dataclass(frozen=True)
class Batch:
    label: str
    ancestor: Header | None
    events: tuple[Event, ...] = ()

    @property
    def checkpoint(self) -> Header | None:
        """The last applied header, or the ancestor after rollbacks alone."""
        applied = [e.header for e in self.events if e.kind == "apply"]
        return applied[-1] if applied else self.ancestor

    @property
    def depth(self) -> int:
        n = [e.kind for e in self.events]
        return max(n.count("rollback"), n.count("apply")) if self.label == "reorg" else 0


@dataclass
class ChainState:
    """The canonical headers that are known; ``commit`` folds a batch in."""

    canonical: dict[int, Header] = field(default_factory=dict)
    tip: Header | None = None
    finalized_height: int | None = None

    def holds(self, h: Header) -> bool:
        return self.canonical.get(h.height) == h

    def commit(self, batch: Batch) -> None:
        for e in batch.events:
            if e.kind == "rollback":
                del self.canonical[e.header.height]
            else:
                self.canonical[e.header.height] = e.header
        if batch.events:
            self.tip = batch.checkpoint


Resolver = Callable[[str], Header | None]


def plan_transition(state: ChainState, head: Header, resolve: Resolver, max_depth: int = MAX_DEPTH) -> Batch:
    """The batch that makes head the tip; the state stays as it is, and errors leave nothing behind.

    Each branch may be max_depth long, not longer; a gap counts as a branch.  The ancestor may be the finalized block itself.
    """
    tip = state.tip
    if state.holds(head) and head == tip or tip and head.block_hash == tip.block_hash:
        return Batch("duplicate", head)
    if tip is None:
        if head.height:
            raise MissingParent(f"the first block is at height {head.height}, not 0")
        return Batch("bootstrap", None, (Event("apply", head),))
    if head.parent_hash == tip.block_hash:
        if head.height != tip.height + 1:
            raise InvalidHeight(f"height {head.height} on a parent at {tip.height}")
        return Batch("extend", tip, (Event("apply", head),))
    branch, at = [], head
    while not state.holds(at):
        branch.append(at)
        if len(branch) > max_depth:
            raise DepthExceeded(f"no canonical ancestor within {max_depth} blocks")
        below = state.canonical.get(at.height - 1)
        parent = below if below and below.block_hash == at.parent_hash else resolve(at.parent_hash)
        if parent is None:
            raise MissingParent(at.parent_hash)
        if parent.block_hash != at.parent_hash or parent.height != at.height - 1:
            raise InvalidHeight(f"{parent} is not the parent of {at}")
        at = parent
    if state.finalized_height is not None and at.height < state.finalized_height:
        raise CrossesFinalized(f"the ancestor at {at.height} lies below the finalized {state.finalized_height}")
    back, node = [], tip
    while node != at:
        back.append(Event("rollback", node))
        if len(back) > max_depth:
            raise DepthExceeded(f"more than {max_depth} blocks to roll back")
        parent = state.canonical.get(node.height - 1)
        if parent is None or parent.block_hash != node.parent_hash:
            raise MissingParent(node.parent_hash)
        node = parent
    events = (*back, *(Event("apply", h) for h in reversed(branch)))
    label = "duplicate" if not events else "reorg" if back else "gap"
    return Batch(label, at, events)


def stored_resolver(blocks: DataFrame) -> Resolver:
    """Parents from the stored blocks, one point lookup each."""

    def resolve(block_hash: str) -> Header | None:
        row = blocks.where(blocks["block_hash"] == block_hash).select("block_hash", "parent_hash", "height").first()
        return Header(*row) if row else None

    return resolve


def state_of(blocks: DataFrame, last_height: int, depth: int = MAX_DEPTH, finalized_height: int | None = None) -> ChainState:
    """The canonical headers down to ``depth`` below the checkpoint: a bounded collect."""
    rows = blocks.where("is_canonical").where((blocks["height"] <= last_height) & (blocks["height"] >= last_height - depth - 1)).select("block_hash", "parent_hash", "height").collect()
    found = {r["height"]: Header(*r) for r in rows}
    return ChainState(found, found.get(last_height), finalized_height)


def ancestor_walk(spark: SparkSession, blocks: DataFrame, start_hash: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """step, height, block_hash, is_canonical from a block down to the first canonical one, max_depth steps at most.

    The start is looked up first, so that each step reads the heights from max_depth below it alone.
    """
    start = blocks.where(blocks["block_hash"] == start_hash).select("height").first()
    top = start["height"] if start else -1
    near = blocks.where(blocks["height"].between(top - max_depth, top)).select("height", "block_hash", "parent_hash", "is_canonical")
    return spark.sql(
        f"""
        WITH RECURSIVE walk (step, height, block_hash, parent_hash, is_canonical) MAX RECURSION LEVEL {int(max_depth) + 2} AS (
          SELECT 0, height, block_hash, parent_hash, is_canonical FROM {{b}} WHERE block_hash = :start
          UNION ALL
          SELECT w.step + 1, p.height, p.block_hash, p.parent_hash, p.is_canonical
          FROM walk w JOIN {{b}} p ON p.block_hash = w.parent_hash AND p.height = w.height - 1 WHERE NOT w.is_canonical)
        SELECT step, height, block_hash, is_canonical FROM walk""",
        args={"start": start_hash}, b=near,
    )


def reorg_plan(spark: SparkSession, blocks: DataFrame, head_hash: str, tip_height: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """seq, event_kind, height, block_hash of the switch from the canonical tip to a stored branch's head.

    The query fails if the walk meets no canonical block within max_depth, or if more than max_depth blocks would be rolled back.
    """
    walk = ancestor_walk(spark, blocks, head_hash, max_depth)
    blocks = blocks.where(blocks["height"] <= tip_height).where(blocks["height"] >= tip_height - max_depth)
    return spark.sql(
        """
        WITH w AS (SELECT * FROM {walk}), found AS (SELECT max(height) AS h FROM w WHERE is_canonical),
        a AS (SELECT CASE WHEN h IS NULL THEN raise_error('no canonical ancestor within the depth allowed') WHEN {tip} - h > {depth} THEN raise_error('more blocks to roll back than the depth allows') ELSE h END AS h FROM found),
        r AS (SELECT 'rollback' AS event_kind, b.height, b.block_hash, b.height - {tip} AS o FROM {b} b JOIN a ON b.height > a.h WHERE b.is_canonical AND b.height <= {tip}),
        p AS (SELECT 'apply' AS event_kind, height, block_hash, height AS o FROM w CROSS JOIN a WHERE NOT is_canonical AND w.height > a.h)
        SELECT CAST(row_number() OVER (ORDER BY event_kind DESC, CASE event_kind WHEN 'rollback' THEN -o ELSE o END) - 1 AS BIGINT) AS seq, event_kind, height, block_hash
        FROM (SELECT * FROM r UNION ALL SELECT * FROM p)""",
        walk=walk, b=blocks, tip=tip_height, depth=max_depth,
    )
