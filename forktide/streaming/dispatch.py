"""Ordered dispatch of a journal by position, and consumer-side dedup with bounded state.

A journal is segments of consecutive ids.  The dispatcher reads the segments behind the position, a part at a time, in the order of
their ids, hands each part to the sink and then moves the position on.  So every segment is read once, nothing overtakes, the first error
ends it, and a crash between sink and position delivers the same ids again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from forktide.operators.journal import messages
from forktide.plans.manifest import Files
from forktide.plans.snapshot import Store


class Segmented(Protocol):
    """A journal in segments; a segment has low and high, the ids that it may hold."""

    def waiting(self) -> list[dict]: ...

    def rows(self, segments: list[dict]) -> DataFrame: ...

    def mark(self, low: int, high: int) -> None: ...


@dataclass
class StoreJournal:
    """A store's journal; the position is part of its manifest."""

    store: Store

    def waiting(self) -> list[dict]:
        return self.store.unpublished()

    def rows(self, segments: list[dict]) -> DataFrame:
        return self.store.pending(segments).withColumnRenamed("height", "block_height")

    def mark(self, low: int, high: int) -> None:
        self.store.mark_range(low, high)


@dataclass
class FolderJournal:
    """What waits in a journal that another system wrote, staged by ranges of ids: a folder ``ids=n`` for each ``span`` ids; the position is a file beside it."""

    spark: SparkSession
    path: str
    schema: str
    span: int

    @classmethod
    def staged(cls, journal: DataFrame, path: str, span: int) -> FolderJournal:
        waiting = journal.where("published_at IS NULL")  # what was published is not read again
        waiting.withColumn("ids", F.floor(F.col("event_id") / span)).repartition("ids").sortWithinPartitions("ids", "event_id").write.partitionBy("ids").parquet(path)
        return cls(journal.sparkSession, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in journal.schema), span)

    def __post_init__(self):
        self.files = Files(self.spark, self.path)

    def _marks(self) -> list[int]:
        return sorted(int(n.removeprefix("upto-")) for n in self.files.names(f"{self.path}-position") if n.startswith("upto-"))

    def waiting(self) -> list[dict]:
        upto = max(self._marks(), default=None)
        found = sorted(int(n.removeprefix("ids=")) for n in self.files.names(self.path) if n.startswith("ids="))
        return [{"low": n * self.span, "high": (n + 1) * self.span - 1, "n": n} for n in found if upto is None or (n + 1) * self.span - 1 > upto]

    def rows(self, segments: list[dict]) -> DataFrame:
        folders = [f"{self.path}/ids={s['n']}" for s in segments]
        return self.spark.read.schema(self.schema).parquet(*folders).where("published_at IS NULL")

    def mark(self, low: int, high: int) -> None:
        self.files.fs.mkdirs(self.files.at(f"{self.path}-position"))
        self.files.make(f"{self.path}-position/upto-{high}", json.dumps([low, high]))


@dataclass
class Dispatcher:
    journal: Segmented
    chain_id: int
    sink: Callable[[DataFrame], None]
    #: A part is whole segments with up to so many ids, or one larger segment.
    ids: int = 1000
    #: Segments that were read, for a report.
    read: list[tuple[int, int]] = field(default_factory=list)

    def step(self) -> tuple[int, int] | None:
        """Publish the next part; its range of ids, or None if nothing waits."""
        part: list[dict] = []
        for s in self.journal.waiting():
            if part and s["high"] - part[0]["low"] >= self.ids:
                break
            part.append(s)
        if not part:
            return None
        low, high = part[0]["low"], part[-1]["high"]
        self.read += [(s["low"], s["high"]) for s in part]
        out = messages(self.journal.rows(part), self.chain_id)
        self.sink(out.coalesce(1).sortWithinPartitions("event_id"))  # one key of the broker: one writer, in order
        self.journal.mark(low, high)
        return low, high

    def drain(self) -> int:
        """Publish what waits; the number of parts."""
        n = 0
        while self.step():
            n += 1
        return n

    def stream(self, spark: SparkSession, poll_seconds: float, checkpoint: str | None = None) -> StreamingQuery:
        """Drain every ``poll_seconds``; the first error of the sink ends the query, and the next one begins at the same id."""
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        writer = ticks.writeStream.foreachBatch(lambda _, __: self.drain() and None).trigger(processingTime=f"{poll_seconds} seconds")
        return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def dispatched_once(spark: SparkSession, outbox: DataFrame, path: str, chain_id: int = 5, span: int = 1 << 17, ids: int = 1 << 20) -> DataFrame:
    """Dispatch a journal to its end, a file a part; what was published, and whether it came after all smaller ids (in_order).

    A part is a job of its own behind the one before, so it takes many ids: its rows are streamed and sorted by one task, which may spill.
    """
    journal, turn = FolderJournal.staged(outbox, f"{path}/journal", span), iter(range(1 << 62))

    def sink(part: DataFrame) -> None:
        header = F.concat_ws(",", F.transform("headers", lambda h: F.concat_ws("=", h["key"], h["value"].cast("string"))))
        row = F.monotonically_increasing_id()  # of one partition: the place in the part
        part.select("event_id", "key", "value", header.alias("headers"), row.alias("row")).withColumn("part", F.lit(next(turn))).write.mode("append").parquet(f"{path}/published")

    Dispatcher(journal, chain_id, sink, ids).drain()
    out = spark.read.schema("event_id bigint, key string, value string, headers string, row bigint, part int").parquet(f"{path}/published")
    tops = out.groupBy("part").agg(F.max("event_id").alias("top"))  # a row a part
    before = tops.select("part", F.max("top").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    last = F.coalesce(F.lag("event_id").over(Window.partitionBy("part").orderBy("row")), "before", F.lit(-1))
    return out.join(before, "part").withColumn("in_order", F.col("event_id") > last).select("event_id", "key", "value", "headers", "in_order")


#: Keys of the state: ids by their remainder, so that each key's ids are as gapless as the journal.
STATE_KEYS = 16
SEEN = "upto long, beyond array<long>"


def _seen(upto: int, low: np.ndarray, high: np.ndarray, ids: np.ndarray, step: int) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """(which of the distinct, ascending ids are new, and the state after them).  Ranges are disjoint and in order, so an id is looked up by bisection."""
    at = np.searchsorted(low, ids, "right")
    new = (ids > upto) & (ids > np.concatenate([[upto], high])[at])
    lows, highs = np.concatenate([low, ids[new]]), np.concatenate([high, ids[new]])
    order = np.argsort(lows, kind="stable")
    lows, highs = lows[order], highs[order]
    apart = lows[1:] > highs[:-1] + step
    lows, highs = lows[np.concatenate([[True], apart])[: len(lows)]], highs[np.concatenate([apart, [True]])[: len(highs)]]
    if len(lows) and lows[0] <= upto + step:
        upto, lows, highs = int(highs[0]), lows[1:], highs[1:]
    return new, upto, lows, highs


def first_seen(upto: int, beyond: list[int], ids: list[int], step: int = 1) -> tuple[list[int], int, list[int]]:
    """(the ids that are new, in order, and the state after them).  Seen are all ids up to ``upto`` and the ranges in ``beyond`` (low, high, low, high...)."""
    spans, distinct = np.asarray(beyond, np.int64).reshape(-1, 2), np.unique(np.asarray(ids, np.int64))
    new, upto, low, high = _seen(upto, spans[:, 0], spans[:, 1], distinct, step)
    return distinct[new].tolist(), upto, np.stack([low, high], 1).ravel().tolist()


def deduplicated_bounded(deliveries: DataFrame, first_id: int = 0) -> DataFrame:
    """Each event id of a stream once.  The state is, for STATE_KEYS keys, how far the ids are gapless and the ranges beyond: it does not grow with a
    gapless journal, whatever is delivered again and in whatever order.  Ids below ``first_id`` are taken for delivered."""
    columns = deliveries.columns
    out_schema = deliveries.schema

    def f(key: tuple[int], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        low = first_id + (key[0] - first_id) % STATE_KEYS
        upto, beyond = state.get if state.exists else (low - STATE_KEYS, [])
        spans = np.asarray(beyond, np.int64).reshape(-1, 2)
        low, high = spans[:, 0], spans[:, 1]
        for rows in parts:
            ids, first = np.unique(rows["event_id"].to_numpy(), return_index=True)
            new, upto, low, high = _seen(upto, low, high, ids, STATE_KEYS)
            yield rows.iloc[np.sort(first[new])][columns]
        state.update((upto, np.stack([low, high], 1).ravel().tolist()))

    keyed = deliveries.withColumn("_key", F.pmod("event_id", F.lit(STATE_KEYS)).cast("int"))
    return keyed.groupBy("_key").applyInPandasWithState(f, out_schema, SEEN, "append", GroupStateTimeout.NoTimeout)


def deduplicated_once(spark: SparkSession, deliveries: DataFrame, path: str) -> DataFrame:
    deliveries.write.mode("overwrite").parquet(f"{path}/deliveries")
    stream = spark.readStream.schema(deliveries.schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/deliveries")
    done = deduplicated_bounded(stream).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.schema(deliveries.schema).parquet(f"{path}/out")

